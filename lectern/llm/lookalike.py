"""Visually identical text with different characters.

One form for equal-looking texts: composed letters (NFC), ASCII for full-width
letters and digits, full-size kana, the ordinary space, no invisible characters,
and one alphabet per word. The alphabet of a word is repaired by script: letters
are mapped to the text's (or the word's) script only where a token mixes scripts
or stands alone in a foreign script between words of the text's script, and only
where the corpus vocabulary, that is the words of all texts, holds the result.

The repaired forms of all doubtful tokens are few: their distinct words are looked up
in the vocabulary (in the tasks that read the texts while they are few enough to be
sent there, else by a join of distinct words), and only texts with such a token are
shuffled.

Customary spelling stays: full-width punctuation, quotes, dashes, the no-break
space before French marks, joiners and variation marks inside emoji, and joiners
between letters of Arabic or Indic scripts.

Defined results
---------------
* null text gives no row; blank text has no case and its clean form is itself
  (with ordinary spaces);
* a token is repaired to the first of its forms (text's script, script of most of its
  letters, Latin, Cyrillic) that the vocabulary holds; if it holds none, the token
  stays and is no case; a token may have any length;
* rows repeated under other ids, or under the same, are judged one by one; extra
  columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
import unicodedata as ud
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.operators.arrow import map_columns
from lectern.operators.lookup import salted
from lectern.session import cut

# Letters drawn alike, given as foreign letter and Latin letter.
_ALIKE = (
    "аa ѕs сc ԁd еe һh іi їï јj ӏl оo рp ԛq уy хx ѵv ԝw ёë ҽe ʏy "
    "АA ВB СC ԀD ЕE НH ІI ЇÏ ЈJ КK МM ОO РP ЅS ТT ХX УY ҮY ԚQ ԜW ѴV ӀI ЁË ԌG "
    "οo νv υu ιi αa ρp κk τt χx γy ωw ϲc ϳj εe ηn σo "
    "ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX "
    "ոn հh օo սu ցg զq յj ԛq ՕO ՏS ՍU ԼL աw "
    "ᎪA ᏴB ᏟC ᎠD ᎬE ᎻH ᎫJ ᏦK ᏞL ᎷM ᏢP ᎡR ᏚS ᎢT ᏙV ᎳW ᏃZ"
)
PROTOTYPE = {pair[0]: pair[1] for pair in _ALIKE.split()}
_TO_CYRILLIC = {v: k for k, v in reversed(PROTOTYPE.items()) if "Ѐ" <= k <= "ԯ"} | {"i": "і", "k": "к", "u": "и"}
_TO_CYRILLIC.pop("u")

#: Russian words of one letter.
ONE_LETTER = "авикосуя"

INVISIBLE = (
    "­͏؜ᅟᅠ឴឵᠋-᠏​-‏‪-‮⁠-⁯"
    "ㅤ︀-️﻿ﾠ\U000e0000-\U000e0fff"
)
SPACES = "   -   　"
_WIDE = "０-９Ａ-Ｚａ-ｚ"
_KANA = "ｦ-ﾟ"
_MATH = "\U0001d400-\U0001d7ff"
_SINGLETON = "ΩKÅ豈-﫿\U0002f800-\U0002fa1f"


def _composers() -> str:
    """Characters that join a base into one composed character, by Unicode's own
    decomposition data."""
    found = set()
    for cp in range(0xC0, 0x30000):
        parts = ud.decomposition(chr(cp)).split()
        if len(parts) == 2 and parts[0][0] != "<":
            whole = chr(int(parts[0], 16)) + chr(int(parts[1], 16))
            if ud.normalize("NFC", whole) == chr(cp):
                found.add(int(parts[1], 16))
    found |= set(range(0x1161, 0x1176)) | set(range(0x11A8, 0x11C3))
    return "".join(f"\\u{c:04x}" if c < 0x10000 else f"\\U{c:08x}" for c in sorted(found))


@lru_cache(1)
def _patterns() -> dict:
    joiners = _composers()
    return {
        "compose": re.compile(f".[{joiners}]+", re.DOTALL),
        "any": re.compile(f"[{INVISIBLE}{SPACES}{_WIDE}{_KANA}{_MATH}{_SINGLETON}{joiners}]"),
    }


_INVISIBLE = re.compile(f"[{INVISIBLE}]")
_ODD_SPACE = re.compile(f"[{SPACES}]")
_FRENCH = re.compile("[  ](?=[?!;:»])|(?<=«)[  ]")
_WIDE_RUN = re.compile(f"[{_WIDE}{_MATH}{_SINGLETON}]")
_KANA_RUN = re.compile(f"[{_KANA}]+")
_EMOJI = re.compile("[©®‼-㊙\U0001f000-\U0001faff#*0-9\U0001f3fb-\U0001f3ff️‍⃣]")
_JOINING = re.compile("[؀-ۿݐ-ݿऀ-෿]")
_WORD = re.compile(
    "[A-Za-zªºÀ-ÖØ-öø-ɏḀ-ỿͰ-ϿЀ-ԯԱ-ևᎠ-Ᏽ̀-ͯ]+"
)


#: Cyrillic letters outside the Russian alphabet: a whole word is not read into them.
_RARE = re.compile("[\u0400\u0402-\u040f\u0450\u0452-\u052f]")


def script_of(ch: str) -> str:
    if ch < "̀":
        return "latin"
    if ch < "Ͱ":
        return ""  # combining marks go with any script
    if ch < "Ѐ":
        return "greek"
    if ch < "԰":
        return "cyrillic"
    if ch < "֐":
        return "armenian"
    if "Ꭰ" <= ch < "᐀":
        return "cherokee"
    return "latin"


def _drop_invisible(text: str) -> tuple[str, bool]:
    hit = False

    def keep(m: re.Match) -> str:
        nonlocal hit
        ch, at = m[0], m.start()
        before, after = text[at - 1 : at], text[at + 1 : at + 2]
        if ch in "‍︎️‌" or "\U000e0020" <= ch <= "\U000e007f":
            if ch in "︎️" and _EMOJI.match(before):
                return ch
            if ch == "‍" and _EMOJI.match(before) and _EMOJI.match(after):
                return ch
            if ch in "‌‍" and _JOINING.match(before) and _JOINING.match(after):
                return ch
            if ch > "\U000e0000" and ("\U0001f3f4" in text[:at]):
                return ch
        hit = True
        return ""

    return _INVISIBLE.sub(keep, text), hit


def fold_characters(text: str) -> tuple[str, bool]:
    """Everything but alphabets: (text in one form, whether a case was met)."""
    if not _patterns()["any"].search(text):
        return text, False
    out, hit = _drop_invisible(text)
    kept = {m.start() for m in _FRENCH.finditer(out)}

    def space(m: re.Match) -> str:
        nonlocal hit
        if m.start() in kept:
            return m[0]
        hit = True
        return " "

    out = _ODD_SPACE.sub(space, out)

    def fold(m: re.Match) -> str:
        nonlocal hit
        hit = True
        return ud.normalize("NFKC", m[0])

    out = _KANA_RUN.sub(fold, _WIDE_RUN.sub(fold, out))

    def compose(m: re.Match) -> str:
        nonlocal hit
        whole = ud.normalize("NFC", m[0])
        if len(whole) < len(m[0]) and m[0][0].isalpha():
            hit = True
        return whole

    return _patterns()["compose"].sub(compose, out), hit


def map_word(word: str, target: str) -> str | None:
    """The word in the target script, or None where a letter has no twin there."""
    out = []
    for ch in word:
        s = script_of(ch)
        if s in (target, ""):
            out.append(ch)
            continue
        twin = PROTOTYPE.get(ch) if target == "latin" else _TO_CYRILLIC.get(PROTOTYPE.get(ch, ch))
        if twin is None:
            return None
        out.append(twin)
    return ud.normalize("NFC", "".join(out))


def candidates(text: str) -> list[tuple[int, int, list[str]]]:
    """(start, end, repaired forms in order of preference) for tokens of a folded text
    whose alphabet is in doubt."""
    words = [(m.start(), m.end(), m[0]) for m in _WORD.finditer(text)]
    if not words:
        return []
    counts: dict[str, int] = {}
    scripts = []
    for _, _, w in words:
        own: dict[str, int] = {}
        for ch in w:
            s = script_of(ch)
            if s:
                own[s] = own.get(s, 0) + 1
        scripts.append(own)
        for s, n in own.items():
            counts[s] = counts.get(s, 0) + n
    if len(counts) < 2 and not counts.keys() & {"greek", "armenian", "cherokee"}:
        return []
    # Cyrillic that could all be read as Latin is no Cyrillic text
    real = any(script_of(ch) == "cyrillic" and ch not in PROTOTYPE for _, _, w in words for ch in w) if "cyrillic" in counts else False
    main = "cyrillic" if real and counts["cyrillic"] > counts.get("latin", 0) else "latin"
    found: list[tuple[int, int, list[str]]] = []
    doubtful = set()
    alone = []
    for k, ((a, b, w), own) in enumerate(zip(words, scripts)):
        if len(own) > 1:
            most = max(own, key=lambda s: (own[s], s == main))
            targets = (t for t in dict.fromkeys((main, most, "latin", "cyrillic")) if t in ("latin", "cyrillic"))
            forms = list(dict.fromkeys(filter(None, (map_word(w, t) for t in targets))))
            if forms:
                doubtful.add(k)
                found.append((a, b, forms))
        elif own and main not in own and (fixed := map_word(w, main)) and not (main == "cyrillic" and _RARE.search(fixed)):
            alone.append((k, fixed))
            doubtful.add(k)
    for k, fixed in alone:
        a, b, w = words[k]
        if len(fixed) == 1 and main == "cyrillic" and fixed.lower() not in ONE_LETTER:
            continue
        if re.match(r"[\d@_\-/\]):：.]|\.\w", text[b : b + 2]) and main == "cyrillic" or re.search(r"[\d@_\-/.]$", text[max(0, a - 1) : a]):
            continue  # part of a code, address or label
        left = next((scripts[j] for j in range(k - 1, -1, -1) if j not in doubtful and scripts[j]), None)
        right = next((scripts[j] for j in range(k + 1, len(words)) if j not in doubtful and scripts[j]), None)
        near = [s for s in (left, right) if s]
        if all(main in s for s in near) and (near or not real):
            found.append((a, b, [fixed]))
    return sorted(found)


_MAYBE = re.compile(r"[Ͱ-֏Ꭰ-᏿]")


def one_form(text: str) -> str:
    """Folded text with every doubtful token in its first form, without asking the
    vocabulary: for readers that only compare words with each other."""
    clean, _ = fold_characters(text)
    if not _MAYBE.search(clean):
        return clean
    at, out = 0, []
    for a, b, forms in candidates(clean):
        out += [clean[at:a], forms[0]]
        at = b
    return "".join(out) + clean[at:] if out else clean


_LATIN = re.compile("[A-Za-zÀ-ɏ]")
_ODD_ALPHABET = re.compile("[Ͱ-Ͽ԰-֏Ꭰ-᏿]")


def suspect(text: str) -> bool:
    """True if a text may hold a case; all others are in the one form already. A
    character set in C is some twenty times cheaper here than Java's pattern."""
    if _patterns()["any"].search(text):
        return True
    return bool(_MAYBE.search(text)) and (bool(_LATIN.search(text)) or bool(_ODD_ALPHABET.search(text)))


_TOKENS = "array<struct<start:int,stop:int,words:array<string>>>"


def _read(df: DataFrame, keep: str) -> DataFrame:
    """(payload_id, field, text, folded, hit, tokens) of ``df`` (payload_id, field, text).
    ``keep`` tells which rows come back: ``cases`` (without texts), ``doubtful`` (with a
    doubtful token) or ``plain`` (all others)."""

    def kernel(columns: dict) -> dict:
        out = {n: [] for n in ("payload_id", "field", "text", "folded", "hit", "tokens")}
        for i, field, text in zip(columns["payload_id"], columns["field"], columns["text"]):
            folded, hit, tokens = text, False, []
            if suspect(text):
                folded, hit = fold_characters(text)
                tokens = [{"start": a, "stop": b, "words": w} for a, b, w in candidates(folded)]
            if keep == "cases":
                if hit or tokens:
                    for n, v in zip(out, (i, field, None, None, hit, tokens)):
                        out[n].append(v)
            elif bool(tokens) == (keep == "doubtful"):
                for n, v in zip(out, (i, field, text, folded, hit, tokens)):
                    out[n].append(v)
        return out

    return map_columns(df, kernel, f"payload_id bigint, field string, text string, folded string, hit boolean, tokens {_TOKENS}")


FIELDS = ("source_text", "corrected_text")


def long_form(df: DataFrame) -> DataFrame:
    """(payload_id, field, text) of both fields, nulls left out."""
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in FIELDS])
    return df.select("payload_id", F.inline(pairs)).filter("text IS NOT NULL")


#: Candidate words that may be sent to all tasks; more are looked up by a join.
SENT_WORDS = 200_000
#: Words of more characters are looked up by their SHA-256, so the words sent are bounded.
WHOLE_WORD = 40


def _sought(word: Column) -> Column:
    """What a word is looked up by: itself, or the digest (64 characters, so no other
    word's) of a longer one."""
    return F.when(F.length(word) <= WHOLE_WORD, word).otherwise(F.sha2(word, 256))


def known_words(texts: DataFrame, words: DataFrame) -> DataFrame:
    """The rows of ``words`` (distinct ``word``, lower case, long ones as ``_sought``) that
    stand in any text."""
    said = F.array_distinct(F.split(F.lower("text"), r"[^\p{L}\p{M}]+"))
    spoken = texts.select(F.explode(said).alias("word")).select(_sought(F.col("word")).alias("word"))
    if words.count() <= SENT_WORDS:
        return spoken.join(F.broadcast(words), "word", "left_semi").distinct()
    return words.join(spoken.distinct(), "word", "left_semi")


def _asked(marked: DataFrame, *key: str) -> DataFrame:
    """(key, start, stop, rank, written, word) of every form of every doubtful token;
    ``word`` is what it is looked up by."""
    token = marked.select(*key, F.explode("tokens").alias("t"))
    form = token.select(*key, "t.start", "t.stop", F.posexplode("t.words").alias("rank", "written"))
    return form.withColumn("word", _sought(F.lower("written")))


def _known(df: DataFrame, marked: DataFrame) -> DataFrame:
    """Words of the vocabulary among the forms of doubtful tokens."""
    words = _asked(marked).select("word").distinct()
    return known_words(long_form(df), cut(words))


def found(df: DataFrame) -> DataFrame:
    """(payload_id, field) of texts that hold a stand-in character. The marks (ids and
    forms, no texts) are written once and read for the lookup and the result."""
    marked = cut(_read(long_form(df), "cases").select("payload_id", "field", "hit", "tokens"))
    direct = marked.filter("hit").select("payload_id", "field")
    asked = _asked(marked.filter("NOT hit"), "payload_id", "field").select("payload_id", "field", "word")
    known = salted(asked, _known(df, marked.filter("NOT hit")), "word", ("payload_id", "field"))
    return direct.unionByName(known.select("payload_id", "field").distinct())


def clean(df: DataFrame) -> DataFrame:
    """Every text in one form: (payload_id, field, clean_text, changed). Texts without a
    doubtful token go straight through."""
    texts = long_form(df)
    plain = _read(texts, "plain").select("payload_id", "field", F.col("folded").alias("clean_text"), (F.col("folded") != F.col("text")).alias("changed"))
    key = F.md5(F.concat_ws("\n", F.coalesce(F.col("payload_id").cast("string"), F.lit("")), "field", "text"))
    doubtful = _read(texts, "doubtful").withColumn("key", key)
    known = _known(df, _read(texts, "cases"))
    fixes = salted(_asked(doubtful, "key"), known, "word", ("key",)).groupBy("key").agg(
        F.sort_array(F.collect_set(F.struct("start", "rank", "stop", "written"))).alias("fixes")
    )
    joined = doubtful.select("payload_id", "field", "text", "folded", "key").join(fixes, "key", "left")
    whole = F.aggregate(
        F.coalesce("fixes", F.array().cast("array<struct<start:int,rank:int,stop:int,written:string>>")),
        F.struct(F.lit("").alias("done"), F.lit(0).alias("at")),
        lambda acc, x: F.when(x["start"] < acc["at"], acc).otherwise(
            F.struct(
                F.concat(acc["done"], F.substr("folded", acc["at"] + 1, x["start"] - acc["at"]), x["written"]).alias("done"),
                x["stop"].alias("at"),
            )
        ),
        lambda acc: F.concat(acc["done"], F.substr("folded", acc["at"] + 1, F.lit(2147483647))),
    )
    return plain.unionByName(joined.select("payload_id", "field", whole.alias("clean_text"), (whole != F.col("text")).alias("changed")))
