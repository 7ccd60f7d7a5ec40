"""Large-scale training-data operators: ten corpus operators and their queries.

Nothing else in the library imports this subpackage.
"""
