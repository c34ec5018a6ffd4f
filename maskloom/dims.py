"""Fixed values of the annotation vocabulary, and the small dimensions made from them.

Every dimension here has a fixed number of rows, so it may always be broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Class id = position in this list.
CLASS_NAMES = [
    "background", "head", "neck", "chest", "spine", "hips",
    "shoulder_l", "upper_arm_l", "forearm_l", "hand_l",
    "shoulder_r", "upper_arm_r", "forearm_r", "hand_r",
    "upper_leg_l", "lower_leg_l", "foot_l",
    "upper_leg_r", "lower_leg_r", "foot_r",
    "accessory", "hair_back",
]
# Class colours, by class id.
CLASS_COLOURS = [
    (0, 0, 0), (255, 0, 0), (0, 255, 0), (0, 0, 255), (255, 255, 0), (255, 0, 255),
    (192, 64, 0), (128, 0, 0), (0, 128, 0), (0, 0, 128),
    (0, 64, 192), (128, 128, 0), (128, 0, 128), (0, 128, 128),
    (64, 0, 0), (0, 64, 0), (0, 0, 64),
    (64, 64, 0), (64, 0, 64), (0, 64, 64),
    (128, 128, 128), (200, 200, 50),
]
NUM_CLASSES = len(CLASS_NAMES)
NUM_JOINTS = 19
JOINT_NAMES = CLASS_NAMES[1 : NUM_JOINTS + 1]
BONE_NAMES = CLASS_NAMES[1:21]
HEAD = 1
TORSO = (3, 4, 5)
ARM_L, ARM_R = (6, 7, 8, 9), (10, 11, 12, 13)
LEG_L, LEG_R = (14, 15, 16), (17, 18, 19)
# Left class, right class.
LR_PAIRS = [(6, 10), (7, 11), (8, 12), (9, 13), (14, 17), (15, 18), (16, 19)]
MIRROR = {**dict(LR_PAIRS), **{r: l for l, r in LR_PAIRS}}

# Art styles.
STYLES = [
    "flat", "cel", "soft_cel", "pixel", "painterly",
    "sketch", "ink_wash", "watercolor", "unlit", "textured",
]
# Camera angle name, azimuth and elevation in degrees.
CAMERA_ANGLES = {
    "front": (0, 0),
    "front_22": (22, 0),
    "three_quarter": (45, 0),
    "three_quarter_67": (67, 0),
    "side": (90, 0),
    "side_112": (112, 0),
    "three_quarter_back": (135, 0),
    "three_quarter_back_157": (157, 0),
    "back": (180, 0),
    "three_quarter_back_left": (225, 0),
    "side_left": (270, 0),
    "three_quarter_left": (315, 0),
    "front_high": (0, 25),
    "three_quarter_high": (45, 25),
    "side_high": (90, 25),
    "back_high": (180, 25),
    "front_low": (0, -15),
    "three_quarter_low": (45, -15),
    "side_low": (90, -15),
    "iso_front": (0, 35),
    "iso_front_right": (45, 35),
    "iso_right": (90, 35),
    "iso_back_right": (135, 35),
    "iso_back": (180, 35),
    "iso_back_left": (225, 35),
    "iso_left": (270, 35),
    "iso_front_left": (315, 35),
    "topdown_front": (0, 60),
    "topdown_right": (90, 60),
    "topdown_back": (180, 60),
    "topdown_left": (270, 60),
}
ANGLES = {name: azimuth for name, (azimuth, _) in CAMERA_ANGLES.items()}
ASSET_SOURCES = ["mixamo", "quaternius", "kenney", "sketchfab"]
SPLIT_RATIOS = {"train": 0.8, "val": 0.1, "test": 0.1}
RESOLUTION = 512


def longest_first(names: list[str]) -> list[str]:
    return sorted(names, key=lambda s: (-len(s), s))


def class_rows() -> list[tuple]:
    rows = []
    for i, name in enumerate(CLASS_NAMES):
        side = "l" if name.endswith("_l") else "r" if name.endswith("_r") else None
        group = (
            "head" if i in (1, 21) else "torso" if i in (2, 3, 4, 5)
            else "arm_l" if i in ARM_L else "arm_r" if i in ARM_R
            else "leg_l" if i in LEG_L else "leg_r" if i in LEG_R else "other"
        )
        r, g, b = CLASS_COLOURS[i]
        rows.append((i, name, r, g, b, side, MIRROR.get(i, i), group, 1 <= i <= NUM_JOINTS))
    return rows


def classes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        class_rows(),
        "class_id int, class_name string, r int, g int, b int, side string, pair_id int, body_group string, is_joint boolean",
    )


def joint_names(spark: SparkSession) -> DataFrame:
    return classes(spark).where("is_joint").selectExpr("class_id", "class_name as joint")


def classes_values_sql() -> str:
    """The class dimension as a VALUES list for the check queries."""
    def lit(v):
        return "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v).lower()

    body = ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in class_rows())
    cols = "class_id, class_name, r, g, b, side, pair_id, body_group, is_joint"
    return f"SELECT * FROM (VALUES {body}) AS c({cols})"
