"""Explicit schemas of the annotation documents."""

from __future__ import annotations

SOURCES = (
    "id string, source string, name string, license string, unmapped_bones array<string>, bone_mapping_overrides map<string,int>, "
    "accessories array<struct<name:string,reasons:array<string>>>"
)
JOINTS_MAP = "joints map<string, struct<position:array<double>, confidence:double, visible:boolean>>, bbox array<int>, image_size array<double>"
JOINTS_LIST = "array<struct<id:int, name:string, x:double, y:double, visible:boolean>>"
VERTICES = "vertex_count long, image_size array<int>, vertices array<struct<position:array<int>, weights:map<string,double>>>"
CLIP = "skeleton string, frame_count int, frame_rate double, rotation_order string, frames array<map<string, struct<rotation:array<double>, position:array<double>>>>"
COCO = (
    "images array<struct<id:long, file_name:string, width:int, height:int>>, "
    "annotations array<struct<id:long, image_id:long, category_id:int, area:double, bbox:array<double>, iscrowd:int>>"
)
DEPTH_ORDER = "annotations array<struct<image_id:long, instance_ids:array<long>, depth:array<struct<order:string>>>>"
LABEL_TASKS = (
    "array<struct<id:long, width:int, height:int, annotations:array<struct<result:array<struct<type:string, "
    "value:struct<polygonlabels:array<string>, points:array<array<double>>, keypointlabels:array<string>, x:double, y:double>>>>>>>"
)
CLIP_LABELS = "filename string, action_type string, subcategory string, quality string, compatible string"
LAYER_LABELS = "filename string, label string, confirmed string"
RUNS = "origin string, width int, height int, y int, x0 int, len int, value int"
