"""Character classes in the regex syntax that Java and RE2 share, and predicates for
single characters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code point ranges of the scripts that are written without spaces.
GROUPS = {
    "hangul": r"\x{AC00}-\x{D7AF}",
    "kana": r"\x{3040}-\x{30FF}\x{31F0}-\x{31FF}\x{FF66}-\x{FF9D}\x{1B000}-\x{1B16F}",
    "han": (
        r"\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{2A6DF}\x{2A700}-\x{2B73F}"
        r"\x{2B740}-\x{2B81F}\x{2B820}-\x{2CEAF}\x{2CEB0}-\x{2EBEF}\x{30000}-\x{3134F}\x{2F800}-\x{2FA1F}"
    ),
    "thai": r"\x{0E00}-\x{0E7F}",
    "lao": r"\x{0E80}-\x{0EFF}",
    "khmer": r"\x{1780}-\x{17FF}",
    "myanmar": r"\x{1000}-\x{109F}\x{AA60}-\x{AA7F}\x{A9E0}-\x{A9FF}",
}
NO_SPACE = "".join(v for k, v in GROUPS.items() if k != "hangul")
EMOJI = (
    r"\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}\x{1F900}-\x{1F9FF}\x{1FA00}-\x{1FAFF}"
    r"\x{2600}-\x{27BF}\x{FE00}-\x{FE0F}\x{200D}\x{23E9}-\x{23F3}\x{231A}-\x{231B}\x{2328}\x{23CF}\x{23F8}-\x{23FA}"
    r"\x{25AA}-\x{25AB}\x{25B6}\x{25C0}\x{25FB}-\x{25FE}\x{2934}-\x{2935}\x{2B05}-\x{2B07}\x{2B1B}-\x{2B1C}\x{2B50}\x{2B55}"
    r"\x{3030}\x{303D}\x{3297}\x{3299}\x{1F3FB}-\x{1F3FF}"
)
CONNECTORS = r"\x{0027}\x{2019}\x60.\x{00B7}\x{30FB}\x{02BB}\x{02BC}\p{Pd}"
JOINERS = r"\p{Mn}\p{Mc}\p{Me}\x{200C}\x{200D}\x{FE00}-\x{FE0F}\x{1F3FB}-\x{1F3FF}"
FLAGS = r"\x{1F1E6}-\x{1F1FF}"


def script_group(c: Column) -> Column:
    """Group of the first character, or null."""
    out = F.lit(None).cast("string")
    for name, cls in reversed(GROUPS.items()):
        out = F.when(c.rlike(f"^[{cls}]"), name).otherwise(out)
    return out


def python_class(cls: str) -> str:
    """The same class for Python's ``re``."""
    import re

    return re.sub(r"\\x\{([0-9A-F]+)\}", lambda m: f"\\U{int(m[1], 16):08x}", cls)
