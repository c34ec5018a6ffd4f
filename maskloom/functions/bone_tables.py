"""Fixed values for mapping bone and material names to regions, as plain rows. The matching code is in ``bones``."""

# Names behind a ``mixamorig:`` or ``mixamorig1:`` to ``mixamorig12:`` prefix, and their region.
RIG_NAMES: dict[str, int] = {
    "Head": 1, "HeadTop_End": 1,
    "Neck": 2,
    "Spine2": 3,
    "Spine1": 4, "Spine": 4,
    "Hips": 5,
    "LeftShoulder": 6,
    "LeftArm": 7,
    "LeftForeArm": 8,
    "LeftHand": 9, "LeftHandThumb1": 9, "LeftHandThumb2": 9, "LeftHandThumb3": 9, "LeftHandThumb4": 9, "LeftHandIndex1": 9, "LeftHandIndex2": 9,
    "LeftHandIndex3": 9, "LeftHandIndex4": 9, "LeftHandMiddle1": 9, "LeftHandMiddle2": 9, "LeftHandMiddle3": 9, "LeftHandMiddle4": 9,
    "LeftHandRing1": 9, "LeftHandRing2": 9, "LeftHandRing3": 9, "LeftHandRing4": 9, "LeftHandPinky1": 9, "LeftHandPinky2": 9, "LeftHandPinky3": 9,
    "LeftHandPinky4": 9,
    "RightShoulder": 10,
    "RightArm": 11,
    "RightForeArm": 12,
    "RightHand": 13, "RightHandThumb1": 13, "RightHandThumb2": 13, "RightHandThumb3": 13, "RightHandThumb4": 13, "RightHandIndex1": 13,
    "RightHandIndex2": 13, "RightHandIndex3": 13, "RightHandIndex4": 13, "RightHandMiddle1": 13, "RightHandMiddle2": 13, "RightHandMiddle3": 13,
    "RightHandMiddle4": 13, "RightHandRing1": 13, "RightHandRing2": 13, "RightHandRing3": 13, "RightHandRing4": 13, "RightHandPinky1": 13,
    "RightHandPinky2": 13, "RightHandPinky3": 13, "RightHandPinky4": 13,
    "LeftUpLeg": 14,
    "LeftLeg": 15,
    "LeftFoot": 16, "LeftToeBase": 16, "LeftToe_End": 16,
    "RightUpLeg": 17,
    "RightLeg": 18,
    "RightFoot": 19, "RightToeBase": 19, "RightToe_End": 19,
}

# Names that other rigs give to a region.
ALIASES: dict[str, int] = {
    "head": 1, "Head": 1, "HEAD": 1, "skull": 1, "Skull": 1, "J_Bip_C_Head": 1,
    "neck": 2, "Neck": 2, "NECK": 2, "J_Bip_C_Neck": 2,
    "chest": 3, "Chest": 3, "upper_body": 3, "torso_upper": 3, "Spine2": 3, "Spine02": 3, "J_Bip_C_Chest": 3, "J_Bip_C_UpperChest": 3,
    "spine": 4, "Spine": 4, "Spine1": 4, "Spine01": 4, "torso": 4, "torso_lower": 4, "abdomen": 4, "J_Bip_C_Spine": 4,
    "hips": 5, "Hips": 5, "pelvis": 5, "Pelvis": 5, "root": 5, "Root": 5, "J_Bip_C_Hips": 5,
    "LeftShoulder": 6, "shoulder.L": 6, "Shoulder.L": 6, "clavicle.L": 6, "Clavicle.L": 6, "L_clavicle": 6, "l_clavicle": 6, "L_shoulder": 6,
    "l_shoulder": 6, "clavicle_l": 6, "shoulder_l": 6, "J_Bip_L_Shoulder": 6,
    "upper_arm.L": 7, "upperarm.L": 7, "UpperArm.L": 7, "L_upperarm": 7, "l_upperarm": 7, "upperarm_l": 7, "LeftArm": 7, "J_Bip_L_UpperArm": 7,
    "forearm.L": 8, "Forearm.L": 8, "lower_arm.L": 8, "L_forearm": 8, "l_forearm": 8, "lowerarm_l": 8, "forearm_l": 8, "LeftForeArm": 8,
    "J_Bip_L_LowerArm": 8,
    "hand.L": 9, "Hand.L": 9, "L_hand": 9, "l_hand": 9, "hand_l": 9, "LeftHand": 9, "J_Bip_L_Hand": 9, "J_Bip_L_Index1": 9, "J_Bip_L_Index2": 9,
    "J_Bip_L_Index3": 9, "J_Bip_L_Middle1": 9, "J_Bip_L_Middle2": 9, "J_Bip_L_Middle3": 9, "J_Bip_L_Ring1": 9, "J_Bip_L_Ring2": 9, "J_Bip_L_Ring3": 9,
    "J_Bip_L_Little1": 9, "J_Bip_L_Little2": 9, "J_Bip_L_Little3": 9, "J_Bip_L_Thumb1": 9, "J_Bip_L_Thumb2": 9, "J_Bip_L_Thumb3": 9,
    "RightShoulder": 10, "shoulder.R": 10, "Shoulder.R": 10, "clavicle.R": 10, "Clavicle.R": 10, "R_clavicle": 10, "r_clavicle": 10, "R_shoulder": 10,
    "r_shoulder": 10, "clavicle_r": 10, "shoulder_r": 10, "J_Bip_R_Shoulder": 10,
    "upper_arm.R": 11, "upperarm.R": 11, "UpperArm.R": 11, "R_upperarm": 11, "r_upperarm": 11, "upperarm_r": 11, "RightArm": 11,
    "J_Bip_R_UpperArm": 11,
    "forearm.R": 12, "Forearm.R": 12, "lower_arm.R": 12, "R_forearm": 12, "r_forearm": 12, "lowerarm_r": 12, "forearm_r": 12, "RightForeArm": 12,
    "J_Bip_R_LowerArm": 12,
    "hand.R": 13, "Hand.R": 13, "R_hand": 13, "r_hand": 13, "hand_r": 13, "RightHand": 13, "J_Bip_R_Hand": 13, "J_Bip_R_Index1": 13,
    "J_Bip_R_Index2": 13, "J_Bip_R_Index3": 13, "J_Bip_R_Middle1": 13, "J_Bip_R_Middle2": 13, "J_Bip_R_Middle3": 13, "J_Bip_R_Ring1": 13,
    "J_Bip_R_Ring2": 13, "J_Bip_R_Ring3": 13, "J_Bip_R_Little1": 13, "J_Bip_R_Little2": 13, "J_Bip_R_Little3": 13, "J_Bip_R_Thumb1": 13,
    "J_Bip_R_Thumb2": 13, "J_Bip_R_Thumb3": 13,
    "thigh.L": 14, "Thigh.L": 14, "upper_leg.L": 14, "L_thigh": 14, "l_thigh": 14, "thigh_l": 14, "LeftUpLeg": 14, "J_Bip_L_UpperLeg": 14,
    "shin.L": 15, "Shin.L": 15, "lower_leg.L": 15, "calf.L": 15, "L_calf": 15, "l_calf": 15, "calf_l": 15, "LeftLeg": 15, "J_Bip_L_LowerLeg": 15,
    "foot.L": 16, "Foot.L": 16, "L_foot": 16, "l_foot": 16, "foot_l": 16, "LeftFoot": 16, "toe.L": 16, "LeftToeBase": 16, "J_Bip_L_Foot": 16,
    "J_Bip_L_ToeBase": 16,
    "thigh.R": 17, "Thigh.R": 17, "upper_leg.R": 17, "R_thigh": 17, "r_thigh": 17, "thigh_r": 17, "RightUpLeg": 17, "J_Bip_R_UpperLeg": 17,
    "shin.R": 18, "Shin.R": 18, "lower_leg.R": 18, "calf.R": 18, "R_calf": 18, "r_calf": 18, "calf_r": 18, "RightLeg": 18, "J_Bip_R_LowerLeg": 18,
    "foot.R": 19, "Foot.R": 19, "R_foot": 19, "r_foot": 19, "foot_r": 19, "RightFoot": 19, "toe.R": 19, "RightToeBase": 19, "J_Bip_R_Foot": 19,
    "J_Bip_R_ToeBase": 19,
}

# Humanoid avatar names, camel case.
AVATAR_NAMES: dict[str, int] = {
    "head": 1,
    "neck": 2,
    "upperChest": 3, "chest": 3,
    "spine": 4,
    "hips": 5,
    "leftShoulder": 6,
    "leftUpperArm": 7,
    "leftLowerArm": 8,
    "leftHand": 9, "leftThumbMetacarpal": 9, "leftThumbProximal": 9, "leftThumbDistal": 9, "leftIndexProximal": 9, "leftIndexIntermediate": 9,
    "leftIndexDistal": 9, "leftMiddleProximal": 9, "leftMiddleIntermediate": 9, "leftMiddleDistal": 9, "leftRingProximal": 9,
    "leftRingIntermediate": 9, "leftRingDistal": 9, "leftLittleProximal": 9, "leftLittleIntermediate": 9, "leftLittleDistal": 9,
    "rightShoulder": 10,
    "rightUpperArm": 11,
    "rightLowerArm": 12,
    "rightHand": 13, "rightThumbMetacarpal": 13, "rightThumbProximal": 13, "rightThumbDistal": 13, "rightIndexProximal": 13,
    "rightIndexIntermediate": 13, "rightIndexDistal": 13, "rightMiddleProximal": 13, "rightMiddleIntermediate": 13, "rightMiddleDistal": 13,
    "rightRingProximal": 13, "rightRingIntermediate": 13, "rightRingDistal": 13, "rightLittleProximal": 13, "rightLittleIntermediate": 13,
    "rightLittleDistal": 13,
    "leftUpperLeg": 14,
    "leftLowerLeg": 15,
    "leftFoot": 16, "leftToes": 16,
    "rightUpperLeg": 17,
    "rightLowerLeg": 18,
    "rightFoot": 19, "rightToes": 19,
}

# Keyword rules in order; all words of a rule must occur.
KEYWORD_RULES: list[tuple[tuple[str, ...], int]] = [
    (("head",), 1), (("skull",), 1),
    (("neck",), 2),
    (("chest",), 3), (("spine2",), 3),
    (("spine1",), 4), (("spine",), 4),
    (("hip",), 5), (("pelvis",), 5),
    (("shoulder", "left"), 6), (("shoulder", "l"), 6), (("clavicle", "left"), 6), (("clavicle", "l"), 6),
    (("shoulder", "right"), 10), (("shoulder", "r"), 10), (("clavicle", "right"), 10), (("clavicle", "r"), 10),
    (("forearm", "left"), 8), (("forearm", "l"), 8), (("lower", "arm", "left"), 8), (("lower", "arm", "l"), 8),
    (("arm", "left", "up"), 7), (("arm", "left"), 7), (("arm", "l", "up"), 7), (("upper", "arm", "l"), 7),
    (("hand", "left"), 9), (("hand", "l"), 9), (("finger", "left"), 9), (("finger", "l"), 9), (("thumb", "left"), 9), (("thumb", "l"), 9),
    (("forearm", "right"), 12), (("forearm", "r"), 12), (("lower", "arm", "right"), 12), (("lower", "arm", "r"), 12),
    (("arm", "right", "up"), 11), (("arm", "right"), 11), (("arm", "r", "up"), 11), (("upper", "arm", "r"), 11),
    (("hand", "right"), 13), (("hand", "r"), 13), (("finger", "right"), 13), (("finger", "r"), 13), (("thumb", "right"), 13), (("thumb", "r"), 13),
    (("shin", "left"), 15), (("shin", "l"), 15), (("calf", "left"), 15), (("calf", "l"), 15), (("lower", "leg", "left"), 15),
    (("lower", "leg", "l"), 15),
    (("thigh", "left"), 14), (("thigh", "l"), 14), (("upper", "leg", "left"), 14), (("upper", "leg", "l"), 14), (("leg", "left", "up"), 14),
    (("leg", "l", "up"), 14),
    (("foot", "left"), 16), (("foot", "l"), 16), (("toe", "left"), 16), (("toe", "l"), 16),
    (("shin", "right"), 18), (("shin", "r"), 18), (("calf", "right"), 18), (("calf", "r"), 18), (("lower", "leg", "right"), 18),
    (("lower", "leg", "r"), 18),
    (("thigh", "right"), 17), (("thigh", "r"), 17), (("upper", "leg", "right"), 17), (("upper", "leg", "r"), 17), (("leg", "right", "up"), 17),
    (("leg", "r", "up"), 17),
    (("foot", "right"), 19), (("foot", "r"), 19), (("toe", "right"), 19), (("toe", "r"), 19),
    (("index", "l"), 9), (("middle", "l"), 9), (("ring", "l"), 9), (("little", "l"), 9), (("pinky", "l"), 9), (("thumb", "l"), 9),
    (("index", "r"), 13), (("middle", "r"), 13), (("ring", "r"), 13), (("little", "r"), 13), (("pinky", "r"), 13), (("thumb", "r"), 13),
    (("ball", "l"), 16),
    (("ball", "r"), 19),
    (("hairjoint",), 21), (("hair",), 21),
    (("bust",), 3), (("breast",), 3),
    (("faceeye",), 1), (("facemoutha",), 1), (("facemouthb",), 1),
    (("skirt",), 5), (("cloth",), 5),
    (("sleeve",), 9), (("tipsleeve",), 9),
]

# Token rules for fuzzy matching, in order.
FUZZY_RULES: list[tuple[tuple[str, ...], int]] = [
    (("head",), 1), (("skull",), 1), (("cranium",), 1),
    (("neck",), 2),
    (("chest",), 3), (("upper", "body"), 3), (("upper", "torso"), 3),
    (("spine",), 4), (("torso",), 4), (("abdomen",), 4),
    (("hip",), 5), (("hips",), 5), (("pelvis",), 5), (("root",), 5),
    (("shoulder", "left"), 6), (("clavicle", "left"), 6),
    (("shoulder", "right"), 10), (("clavicle", "right"), 10),
    (("forearm", "left"), 8), (("lower", "arm", "left"), 8),
    (("upper", "arm", "left"), 7), (("arm", "upper", "left"), 7), (("bicep", "left"), 7),
    (("hand", "left"), 9), (("finger", "left"), 9), (("thumb", "left"), 9), (("wrist", "left"), 9),
    (("forearm", "right"), 12), (("lower", "arm", "right"), 12),
    (("upper", "arm", "right"), 11), (("arm", "upper", "right"), 11), (("bicep", "right"), 11),
    (("hand", "right"), 13), (("finger", "right"), 13), (("thumb", "right"), 13), (("wrist", "right"), 13),
    (("shin", "left"), 15), (("calf", "left"), 15), (("lower", "leg", "left"), 15),
    (("thigh", "left"), 14), (("upper", "leg", "left"), 14),
    (("foot", "left"), 16), (("toe", "left"), 16), (("ankle", "left"), 16),
    (("shin", "right"), 18), (("calf", "right"), 18), (("lower", "leg", "right"), 18),
    (("thigh", "right"), 17), (("upper", "leg", "right"), 17),
    (("foot", "right"), 19), (("toe", "right"), 19), (("ankle", "right"), 19),
]

# Words that mark a part as an accessory.
ACCESSORY_WORDS: list[str] = [
    "weapon", "sword", "shield", "bow", "staff", "spear", "axe", "mace", "dagger", "cape", "cloak", "wings", "wing", "tail", "armor", "pauldron",
    "gauntlet", "hat", "helmet", "crown", "headpiece", "headband", "ribbon", "ornament", "jewelry", "necklace", "earring", "accessory", "belt",
    "scarf", "glasses", "mask", "quiver", "backpack", "bag", "pouch",
]

# Material name rules in order: pattern, region name.
MATERIAL_RULES: list[tuple[str, str]] = [
    (r"\bface\b|\bFace_", "head"),
    (r"\beye\b|\bEyeWhite\b|\bEyeIris\b|\bEyeHighlight\b|\bEyeExtra\b", "head"),
    (r"\bbrow\b|\bEyebrow\b", "head"),
    (r"\bhair\b|\bHair(?:[-_]\w+)*\b|\bbangs\b|\bponytail\b|\bahoge\b", "head"),
    (r"\bmouth\b|\btooth\b|\btongue\b", "head"),
    (r"\bear\b", "head"),
    (r"\bnose\b", "head"),
    (r"\bhead\b", "head"),
    (r"\bneck\b", "neck"),
    (r"(?:shoulder).*(?:left|[-_.]?l\b)|(?:left|l[-_.]).*(?:shoulder)", "shoulder_l"),
    (r"(?:shoulder).*(?:right|[-_.]?r\b)|(?:right|r[-_.]).*(?:shoulder)", "shoulder_r"),
    (r"(?:fore[-_]?arm|lower[-_]?arm).*(?:left|[-_.]?l\b)|(?:left|l[-_.]).*(?:fore[-_]?arm|lower[-_]?arm)", "forearm_l"),
    (r"(?:upper[-_]?arm|arm).*(?:left|[-_.]?l\b)|(?:left|l[-_.]).*(?:upper[-_]?arm|arm)", "upper_arm_l"),
    (r"(?:glove|hand|finger).*(?:left|[-_.]?l\b)|(?:left|l[-_.]).*(?:glove|hand|finger)", "hand_l"),
    (r"(?:fore[-_]?arm|lower[-_]?arm).*(?:right|[-_.]?r\b)|(?:right|r[-_.]).*(?:fore[-_]?arm|lower[-_]?arm)", "forearm_r"),
    (r"(?:upper[-_]?arm|arm).*(?:right|[-_.]?r\b)|(?:right|r[-_.]).*(?:upper[-_]?arm|arm)", "upper_arm_r"),
    (r"(?:glove|hand|finger).*(?:right|[-_.]?r\b)|(?:right|r[-_.]).*(?:glove|hand|finger)", "hand_r"),
    (r"(?:shin|lower[-_]?leg|calf).*(?:left|[-_.]?l\b)|(?:left|l[-_.]).*(?:shin|lower[-_]?leg|calf)", "lower_leg_l"),
    (r"(?:thigh|upper[-_]?leg|leg).*(?:left|[-_.]?l\b)|(?:left|l[-_.]).*(?:thigh|upper[-_]?leg|leg)", "upper_leg_l"),
    (r"(?:shoe|foot|toe|sock|boot).*(?:left|[-_.]?l\b)|(?:left|l[-_.]).*(?:shoe|foot|toe|sock|boot)", "foot_l"),
    (r"(?:shin|lower[-_]?leg|calf).*(?:right|[-_.]?r\b)|(?:right|r[-_.]).*(?:shin|lower[-_]?leg|calf)", "lower_leg_r"),
    (r"(?:thigh|upper[-_]?leg|leg).*(?:right|[-_.]?r\b)|(?:right|r[-_.]).*(?:thigh|upper[-_]?leg|leg)", "upper_leg_r"),
    (r"(?:shoe|foot|toe|sock|boot).*(?:right|[-_.]?r\b)|(?:right|r[-_.]).*(?:shoe|foot|toe|sock|boot)", "foot_r"),
    (r"\bhip|pelvis|waist|Outfit_Lower|pants|skirt|shorts", "hips"),
    (r"accessory|ribbon|wing|tail|cape|cloak|weapon|shield|bag|mask|ornament|jewelry|crown|hat|glasses|goggle|belt|scarf|collar", "background"),
    (r"Outfit_Upper|jacket|shirt|vest|coat|blazer|uniform", "chest"),
    (r"\bbody\b|Body|torso|chest|mune|bust", "chest"),
    (r"\bspine\b|\bback\b", "spine"),
]

# Words that mark the main bone of a region, in order of preference.
PRIMARY_WORDS: dict[int, list[str]] = {
    1: ["Head"],
    2: ["Neck"],
    3: ["Spine2"],
    4: ["Spine1"],
    5: ["Hips"],
    6: ["LeftShoulder", "shoulder.L", "clavicle.L"],
    7: ["LeftArm", "upper_arm.L", "L_upperarm"],
    8: ["LeftForeArm", "forearm.L", "L_forearm"],
    9: ["LeftHand", "hand.L", "L_hand"],
    10: ["RightShoulder", "shoulder.R", "clavicle.R"],
    11: ["RightArm", "upper_arm.R", "R_upperarm"],
    12: ["RightForeArm", "forearm.R", "R_forearm"],
    13: ["RightHand", "hand.R", "R_hand"],
    14: ["LeftUpLeg", "thigh.L", "L_thigh"],
    15: ["LeftLeg", "shin.L", "L_calf"],
    16: ["LeftFoot", "foot.L", "L_foot"],
    17: ["RightUpLeg", "thigh.R", "R_thigh"],
    18: ["RightLeg", "shin.R", "R_calf"],
    19: ["RightFoot", "foot.R", "R_foot"],
}
