"""Columns derived from file stems, example ids and free-text names."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from maskloom import dims

# Character part of an example id, first match wins.
CHARACTER_PATTERNS = [
    r"^(humanrig_\d+)_",
    r"^(.+?)_pose_\d+",
    r"^(fbanimehq_\d+)_\d+$",
    r"^(stdgen_\d+)",
    r"^(animerun_[^_]+)_\d+$",
]


def _alternation(names: Iterable[str]) -> str:
    return "|".join(dims.longest_first(list(names)))


def stem_pattern(styles: Iterable[str] = dims.STYLES, angles: Iterable[str] = dims.ANGLES) -> str:
    """``{char}_pose_{nn}[_{angle}]_{style}``; the longest angle and style name wins. Group 3 is text that belongs to neither."""
    return rf"^(.+)_pose_(\d{{2}})(.*?)(?:_({_alternation(angles)}))?_({_alternation(styles)})$"


def parse_stem(stem: str = "stem") -> dict[str, Column]:
    """Parts of a stem. No angle means ``front``; an angle that is not in the list gives NULL (see ``unknown_angles``)."""
    pattern = stem_pattern()
    part = lambda i: F.nullif(F.regexp_extract(stem, pattern, i), F.lit(""))
    parsed = part(1).isNotNull()
    return {
        "p_char": part(1), "p_pose": part(2),
        "p_angle": F.when(parsed, F.coalesce(part(4), F.when(part(3).isNull(), F.lit("front")))), "p_style": part(5),
    }


def unknown_angle(stem: str = "stem") -> Column:
    """The name in the place of the angle when it is none of the list, else NULL."""
    rest = F.nullif(F.regexp_extract(stem, stem_pattern(), 3), F.lit(""))
    return F.when(F.regexp_extract(stem, stem_pattern(), 4) == "", F.ltrim(rest, F.lit("_")))


def strip_style(stem: Column, styles: Iterable[str] = dims.STYLES) -> Column:
    return F.regexp_replace(stem, rf"_({_alternation(styles)})$", "")


def character_id(example: Column) -> Column:
    hits = [F.nullif(F.regexp_extract(example, p, 1), F.lit("")) for p in CHARACTER_PATTERNS]
    return F.coalesce(*hits, example)


def infer_source(
    char_id: Column,
    prefixes: Sequence[str] = dims.ASSET_SOURCES,
    fallback: Column | str = "unknown",
    strict_underscore: bool = False,
    fold_case: bool = True,
) -> Column:
    text = F.lower(char_id) if fold_case else char_id
    out = fallback if isinstance(fallback, Column) else F.lit(fallback)
    for p in reversed(prefixes):
        out = F.when(F.startswith(text, F.lit(p + "_" if strict_underscore else p)), F.lit(p)).otherwise(out)
    return out


def detect_angle(stem: Column, angles: Iterable[str] = dims.ANGLES) -> Column:
    """``_{angle}_`` inside the stem or ``_{angle}`` at its end; longest name first."""
    found = F.regexp_extract(stem, rf"_({_alternation(angles)})(?:_|$)", 1)
    return F.coalesce(F.nullif(found, F.lit("")), F.lit("front"))


def vendor_of(stem: Column, vendors: Sequence[str] = ("chatgpt", "sora", "pixabay"), default: str = "gemini") -> Column:
    return infer_source(stem, vendors, default)


# Text removed from the start of a stem, by vendor.
VENDOR_PREFIXES = {"chatgpt": "chatgpt image ", "sora": "sora_", "pixabay": "pixabay_", "gemini": "Gemini_Generated_Image_"}


def clean_asset_id(stem: Column) -> Column:
    """Vendor, then the rest of the stem with punctuation folded to single underscores."""
    vendor = vendor_of(stem)
    text = F.when(vendor == "chatgpt", F.lower(stem)).otherwise(stem)
    for name, prefix in VENDOR_PREFIXES.items():
        text = F.when(vendor == name, F.regexp_replace(text, f"^{prefix}", "")).otherwise(text)
    text = F.regexp_replace(text, ",", "")
    text = F.regexp_replace(text, r"[\s\-]", "_")
    return F.concat(vendor, F.lit("_"), F.btrim(F.regexp_replace(text, "_+", "_"), F.lit("_")))


# Rig prefixes in front of a bone name.
BONE_PREFIXES = ["mixamorig:"] + [f"mixamorig{n}:" for n in range(1, 13)] + [
    "Bip01_", "Bip001_", "Bip01 ", "Bip001 ", "DEF-", "def_", "ORG-", "MCH-", "CC_Base_", "Bone_", "bone_", "RIG_", "rig_",
]
LATERALITY = {"l": "left", "r": "right"}


def prefix_pattern(prefixes: Sequence[str] = BONE_PREFIXES) -> str:
    return "^(" + "|".join(p.replace("-", "[-]") for p in dims.longest_first(list(prefixes))) + ")"


def strip_bone_prefix(name: Column, prefixes: Sequence[str] = BONE_PREFIXES, fold_case: bool = False) -> Column:
    return F.regexp_replace(name, ("(?i)" if fold_case else "") + prefix_pattern(prefixes), "")


def tokenize_name(name: Column) -> Column:
    """Lower-case tokens of a bone name with l/r spelled out."""
    text = F.regexp_replace(strip_bone_prefix(name, fold_case=True), r"[._]\d+$", "")
    text = F.regexp_replace(text, r"([a-z])([A-Z])", "$1_$2")
    tokens = F.filter(F.split(F.lower(text), r"[_.\-\s]+"), lambda t: t != "")
    return F.transform(tokens, lambda t: F.when(t == "l", "left").when(t == "r", "right").otherwise(t))


def first_rule(name: Column, rules: Sequence[tuple[str, str]], default: str = "UNMAPPED") -> Column:
    """Label of the first case-insensitive pattern found in ``name``."""
    hits = [F.when(F.rlike(name, F.lit(f"(?i){p}")), F.lit(label)) for p, label in rules]
    return F.coalesce(*hits, F.lit(default))


def hash_split(key: Column, seed: int | str, ratios: Sequence[float] = (0.8, 0.1, 0.1)) -> Column:
    """md5(``seed:key``) modulo 1000 against the ratio thresholds; the 128-bit modulus is exact."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key))
    acc = F.lit(0).cast("long")
    for i in range(4):
        word = F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long")
        acc = (acc * (2**32 % 1000) + word) % 1000
    train = int(ratios[0] * 1000)
    val = train + int(ratios[1] * 1000)
    return F.when(acc < train, "train").when(acc < val, "val").otherwise("test")


def swap_side(name: Column) -> Column:
    """``x_l`` <-> ``x_r``; names without a side stay."""
    stem = F.regexp_replace(name, "_[lr]$", "")
    return F.when(name.endswith("_l"), F.concat(stem, F.lit("_r"))).when(
        name.endswith("_r"), F.concat(stem, F.lit("_l"))
    ).otherwise(name)


def disambiguate_side(name: Column, centroid_x: Column) -> Column:
    """A sided label follows the sign of the centroid: positive x is the right side."""
    side = F.when(centroid_x > 0, "r").when(centroid_x < 0, "l")
    stem = F.regexp_replace(name, "_[lr]$", "")
    return F.when(name.rlike("_[lr]$") & side.isNotNull(), F.concat(stem, F.lit("_"), side)).otherwise(name)


def reasons(rules: Mapping[str, Column]) -> Column:
    """Names of the rules that hold, in rule order."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules.items()]))


def first_reason(rules: Mapping[str, Column]) -> Column:
    return F.coalesce(*[F.when(cond, F.lit(name)) for name, cond in rules.items()])
