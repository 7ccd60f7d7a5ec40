"""python -m tidemark QUERY SF_DIR [--dry-run] | analyze SF_DIR | list | list-models | download-models | config [FILE...] [--profile P] | verify"""

import argparse
import json
import sys


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    p.add_argument("command")
    p.add_argument("paths", nargs="*")
    p.add_argument("--dry-run", action="store_true", help="print the plan only")
    p.add_argument("--profile")
    a = p.parse_args(argv)
    from tidemark.plans.stages import verify

    if a.command == "verify":
        found = verify()
        print(*(f"{k}: {'yes' if v else 'no'}" for k, v in found.items()), sep="\n")
        return int(not all(found[k] for k in ("pyspark", "pyarrow", "pandas", "numpy", "java")))
    if a.command == "config":
        from tidemark.plans.config import PRESETS, Config

        config = Config.load(*a.paths, profile=a.profile) if a.paths else Config({"profiles": PRESETS})
        print(json.dumps(config.values, indent=2, sort_keys=True))
        return 0
    if a.command in ("list-models", "download-models"):
        from tidemark.plans import registry

        kinds = {"caption": registry.MODELS, "transcribe": registry.TRANSCRIBERS, "diarize": registry.DIARIZERS}
        print(*(f"{kind}: {name}" for kind, models in kinds.items() for name in models), sep="\n")
        if a.command == "download-models":
            print("nothing to download: models are callables registered by the caller")
        return 0
    from tidemark.plans.queries import QUERIES

    if a.command == "list":
        print(*QUERIES, sep="\n")
        return 0
    names = ["snk_analysis", "best_overlap_share", "agg_speaker_stats"] if a.command == "analyze" else [a.command]
    if not set(names) <= set(QUERIES) or len(a.paths) != 1:
        p.error(f"unknown query {a.command!r} or no folder")
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.getOrCreate()
    for name in names:
        df = QUERIES[name](spark, a.paths[0])
        df.explain("formatted") if a.dry_run else df.show(50, truncate=60)
    return 0


if __name__ == "__main__":
    sys.exit(main())
