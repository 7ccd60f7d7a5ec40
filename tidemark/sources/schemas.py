"""Explicit schemas of the nested documents and their normalised tables."""

from __future__ import annotations

#: Transcript (A), speakers (B), characters (C), matches (D), shots, scenes and analysis, as DDL.
SEGMENT = "struct<segment_id:string,start_time:double,end_time:double,text:string,confidence:double,language:string,emotion:string,emotion_confidence:double,source:string,ocr_text:string>"
SPEAKER = "struct<segment_id:string,speaker_id:string,start_time:double,end_time:double,confidence:double>"
FACE = "struct<detection_id:string,frame_number:int,timestamp:double,bbox:array<double>,confidence:double,character_id:string,embedding:array<float>,quality_score:double,pose:map<string,double>,attributes:map<string,string>,scene_id:int>"
CHARACTER = "struct<character_id:string,num_appearances:int,first_appearance:double,last_appearance:double,total_screen_time:double,average_confidence:double,representative_embeddings:array<array<float>>,appearance_segments:array<struct<start:double,end:double>>,scene_appearances:map<string,int>>"
SCORE = "struct<heuristic_scores:map<string,double>,llm_score:double,final_score:double,confidence_level:string,reasoning:string>"
MATCH = f"struct<match_id:string,character_id:string,dialogue:{SEGMENT},dialogue_segment:{SEGMENT},speaker:{SPEAKER},time_overlap:double,matching_score:{SCORE}>"
SHOT = "struct<shot_id:int,id:int,start:double,start_time:double,end:double,end_time:double,duration:double,keyframe_path:string,confidence:double,transition_type:string>"
SCENE = "struct<scene_id:int,id:int,start:double,start_time:double,end:double,end_time:double,shots:array<int>,contained_shots:array<int>,summary:string,setting:string,mood:string,characters:array<string>,key_actions:array<string>>"
DOCUMENTS = {
    "a": f"video_id string, duration double, segments array<{SEGMENT}>, metadata map<string,string>, created_at string, _corrupt_record string",
    "b": f"video_id string, duration double, num_speakers int, segments array<{SPEAKER}>, metadata map<string,string>, created_at string, _corrupt_record string",
    "c": f"video_id string, duration double, fps double, total_frames int, detections array<{FACE}>, characters map<string,{CHARACTER}>, metadata map<string,string>, created_at string, _corrupt_record string",
    "d": f"video_id string, matches array<{MATCH}>, unmatched_dialogues array<{SEGMENT}>, summary map<string,string>, created_at string, _corrupt_record string",
    "shots": f"video_id string, total_shots int, shots array<{SHOT}>, _corrupt_record string",
    "scenes": f"video_id string, total_scenes int, scenes array<{SCENE}>, _corrupt_record string",
}
LIST_OF = {"a": "segments", "b": "segments", "c": "detections", "d": "matches", "shots": "shots", "scenes": "scenes"}
