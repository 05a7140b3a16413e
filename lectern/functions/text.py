"""Text normalisation as Column expressions: everything stays in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions import classes as K

BLANK = r"^[ \t\n\r]*$"
# Fixed values.
FILE_LABELS = ("filename", "file", "file_name", "corpusname", "corpus", "corpus_name")
TEXT_LABELS = ("input", "input_segment", "segment", "transcription", "text", "content")
# Noise annotations, in lower case.
NOISE_MARKERS = (
    "_bg noise_", "bg noise_", "_b.g. noise_", "_bg speech", "[/cnon]", "[cnon]", "[/cnps]", "[cnps]",
    "[/cspn]", "[cspn]", "_cspn_", "[fill/]", "[hmm]", "_hmm_", "_mouth noise_", "_mouth_noise_",
    "__mouth noise__", "[noise]", "_/noise_", "_noise_", "__noise__", "@noise@", "[noise/]", "[non/]",
    "[non]", "[/nps]", "[nps]", "[s/]", "[sn/]", "[speaker noise]", "_speaker noise_", "_speaker_noise_",
    "[spn/]", "[unin/]", "_noise_noise_", "_bg_noise_", "[_noise_]", "_ns_noise_", "_/click_",
)
# Pairs of quotes.
QUOTE_PAIRS = (('"', '"'), ("“", "”"), ("‘", "’"), ("«", "»"), ("‹", "›"), ("「", "」"), ("『", "』"), ("„", "”"))


def is_blank(c: Column) -> Column:
    return c.isNull() | c.rlike(BLANK)


def sanitize(c: Column) -> Column:
    """Controls and line separators to spaces, runs squeezed, ends trimmed."""
    spaced = F.regexp_replace(c, r"[\x00-\x1F\x7F\x{85}\x{2028}\x{2029}]", " ")
    return F.coalesce(F.trim(F.regexp_replace(spaced, " {2,}", " ")), F.lit(""))


def tsv_cell(c: Column) -> Column:
    return F.translate(c, "\t\n\r", "   ")


def result_newlines(c: Column) -> Column:
    """Line breaks of a model's answer to single spaces."""
    out = F.regexp_replace(c, r"[\x1C-\x1E\x{85}\x{2028}\x{2029}]", "")
    out = F.regexp_replace(out, r"\r\n|[\r\x0B\x0C]", "\n")
    out = F.regexp_replace(out, r"[ \t\n]*\n[ \t\n]*", " ")
    return F.trim(F.regexp_replace(out, " {2,}", " "))


def strip_emojis(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(c, f"[{K.EMOJI}]+", ""), r"[ \t\n\r]{2,}", " "))


def despace(c: Column, hangul: bool = True) -> Column:
    """Drop white space between two characters of one script without spaces."""
    for name, cls in K.GROUPS.items():
        if hangul or name != "hangul":
            c = F.regexp_replace(c, f"(?<=[{cls}])[ \\t\\n\\r]+(?=[{cls}])", "")
    return c


#: Latin letters and digits, and letters of all other scripts; both with their marks.
LATIN_OR_DIGIT = r"[\p{IsLatin}\p{Nd}²³¹⁰⁴-⁹]\p{M}*"
OTHER_LETTER = r"[\p{L}&&[^\p{IsLatin}]]"


def script_boundaries(c: Column) -> Column:
    """A space between Latin letters or digits and letters of other scripts. Marks belong
    to the letter before them; punctuation and symbols keep both sides apart anyway."""
    c = F.regexp_replace(c, f"({LATIN_OR_DIGIT})(?={OTHER_LETTER})", "$1 ")
    return F.regexp_replace(c, rf"({OTHER_LETTER}\p{{M}}*)(?=[\p{{IsLatin}}\p{{Nd}}²³¹⁰⁴-⁹])", "$1 ")


def all_upper(c: Column) -> Column:
    return c.rlike(r"\p{Lu}") & ~c.rlike(r"[\p{Ll}\p{Lt}]")


def all_lower(c: Column) -> Column:
    return c.rlike(r"\p{Ll}") & ~c.rlike(r"[\p{Lu}\p{Lt}]")


def lower_shouting(c: Column) -> Column:
    """Lower case for a text of more than one word that is all upper case, if its
    length stays."""
    low = F.lower(c)
    words = F.size(F.filter(F.split(c, r"[ \t\n\r]+"), lambda w: w.rlike(r"[\p{Lu}\p{Ll}\p{Lt}]")))
    return F.when(all_upper(c) & (words > 1) & (F.length(low) == F.length(c)), low).otherwise(c)


def terminal_mark(c: Column) -> Column:
    return F.regexp_extract(c, r"(\p{P})[ \t\n\r]*$", 1)


def any_mark(c: Column) -> Column:
    return c.rlike(r"\p{P}")


def keep_terminal(corrected: Column, source: Column) -> Column:
    """Make the final punctuation equal the source's, if the source has any."""
    body = F.regexp_replace(F.regexp_replace(corrected, r"[ \t\n\r]+$", ""), r"\p{P}+$", "")
    want, have = terminal_mark(source), terminal_mark(corrected)
    return F.when(any_mark(source) & (want != have), F.concat(body, want)).otherwise(corrected)


FIRST_WORD = rf"^[^\p{{Lu}}\p{{Ll}}\p{{Lt}}]*([\p{{Lu}}\p{{Ll}}\p{{Lt}}]+(?:[{K.CONNECTORS}][\p{{Lu}}\p{{Ll}}\p{{Lt}}]+)*)"


def first_word(c: Column) -> Column:
    """First word of cased letters, inner connectors included."""
    return F.regexp_extract(c, FIRST_WORD, 1)


def keep_first_casing(corrected: Column, source: Column, protected: Column) -> Column:
    """Give the first word the source's casing unless it is or begins a protected span."""
    have, want = first_word(corrected), first_word(source)
    free = ~F.exists(protected, lambda p: (F.lower(p) == F.lower(have)) | F.startswith(F.lower(p), F.concat(F.lower(have), F.lit(" "))))
    start = F.length(F.regexp_extract(corrected, r"^([^\p{Lu}\p{Ll}\p{Lt}]*)", 1))
    swapped = F.concat(F.substr(corrected, F.lit(1), start), want, F.substr(corrected, start + F.length(have) + 1, F.lit(2147483647)))
    return F.when((have != "") & (have != want) & (F.lower(have) == F.lower(want)) & free, swapped).otherwise(corrected)


def has_noise(c: Column) -> Column:
    low = F.lower(c)
    return F.exists(F.array(*map(F.lit, NOISE_MARKERS)), lambda m: F.contains(low, m))


def unquote(c: Column) -> Column:
    """Strip one outer pair of quotes; unescape within plain quotes."""
    t = F.trim(c)
    out = c
    for a, b in reversed(QUOTE_PAIRS):
        inner = F.substr(t, F.lit(2), F.length(t) - 2)
        inner = F.replace(inner, F.lit('\\"'), F.lit('"')) if a == '"' else inner
        out = F.when((F.length(t) >= 2) & F.startswith(t, F.lit(a)) & F.endswith(t, F.lit(b)), inner).otherwise(out)
    return out


def diff_words(c: Column) -> Column:
    """Lower-case words with ``://`` and ``. : , ; /`` split out."""
    # two capitals whose small form hangs on the place or has two characters are mapped first
    low = F.lower(F.translate(c, "\u0130\u03a3", "i\u03c3"))
    spaced = F.regexp_replace(low, r"(://|[.:,;/])", " $1 ")
    return F.filter(F.split(spaced, r"[ \t\n\r]+"), lambda w: w != "")


def no_space_chars(c: Column) -> Column:
    """Characters of the scripts without spaces, in order."""
    return F.regexp_extract_all(c, F.lit(f"([{K.NO_SPACE}])"), F.lit(1))


def needs_space(left: Column, right: Column) -> Column:
    """True if two neighbouring segments are joined with a space."""
    a, b = F.right(left, F.lit(1)), F.left(right, F.lit(1))
    white = a.rlike(r"[ \t\n\r]") | b.rlike(r"[ \t\n\r]")
    same = F.lit(False)
    for name, cls in K.GROUPS.items():
        if name != "hangul":
            same = same | (a.rlike(f"[{cls}]") & b.rlike(f"[{cls}]"))
    marks = a.rlike(r"[\p{P}\p{S}]") & b.rlike(r"[\p{P}\p{S}]")
    return (F.length(left) > 0) & (F.length(right) > 0) & ~(white | same | marks)


def join_parts(parts: Column) -> Column:
    """Ordered parts joined by the boundary rule; empty parts are skipped."""
    return F.aggregate(
        F.filter(parts, lambda p: p.isNotNull() & (p != "")),
        F.lit(""),
        lambda acc, p: F.when(acc == "", p).when(needs_space(acc, p), F.concat(acc, F.lit(" "), p)).otherwise(F.concat(acc, p)),
    )


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, r"(?i)</?(?:b|strong|em|i)>", "")


def cells(row: Column) -> Column:
    return F.split(row, "\t")


def source_id(cells_: Column) -> Column:
    """Last non-blank cell before the text."""
    prefix = F.slice(cells_, F.lit(1), F.greatest(F.size(cells_) - 1, F.lit(0)))
    return F.try_element_at(F.filter(prefix, lambda x: ~is_blank(x)), F.lit(-1))


def is_header(cells_: Column) -> Column:
    label = lambda c: F.replace(F.lower(F.trim(c)), F.lit(" "), F.lit("_"))
    first, last = label(F.element_at(cells_, 1)), label(F.element_at(cells_, -1))
    return F.when(F.size(cells_) >= 2, first.isin(*FILE_LABELS) & last.isin(*TEXT_LABELS)).otherwise(last.isin(*TEXT_LABELS))


def estimate_segments(c: Column, limit: int) -> Column:
    n = F.length(c)
    return F.when((n == 0) | (n <= limit) | F.lit(limit <= 0), 1).otherwise(F.ceil(n / F.lit(max(limit, 1)))).cast("int")


def change_segments(marked: Column) -> Column:
    """Bodies of ``<chg>`` elements."""
    return F.regexp_extract_all(marked, F.lit(r"(?s)<chg>(.*?)</chg>"), F.lit(1))


def join_changes(segments: Column) -> Column:
    kept = F.filter(F.transform(segments, lambda s: F.trim(s)), lambda s: s != "")
    whole = F.array_join(kept, "")
    return F.when(whole.rlike(f"[{K.NO_SPACE}{K.GROUPS['hangul']}]"), whole).otherwise(F.array_join(kept, " "))


def is_comment(c: Column) -> Column:
    return F.ltrim(c).startswith("#")
