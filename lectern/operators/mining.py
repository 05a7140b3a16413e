"""Recurring faults of a corpus: candidates, keys, verdicts and their application.

Candidates are found per line, counted by key over the corpus (one judgement per key
and not per occurrence), judged in batches by a client, and verdicts are applied to
the lines that hold a judged key.

Defined results
---------------
* null lines give nothing; a repeated line counts each time;
* examples of a key are its first three by id and place;
* a key without a verdict, or with an unknown one, stays as it is;
* extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Callable, Iterator
from typing import NamedTuple

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions.classes import GROUPS, python_class
from lectern.operators.arrow import map_columns, map_partition
from lectern.operators.lookup import salted
from lectern.operators.segment import CLOSERS, MARKS
from lectern.session import cut

#: Longest word of a key, examples of a key, partial examples kept per task at once.
LONGEST, EXAMPLES, HELD_KEYS = 20, 3, 100_000
EXAMPLE_SALTS = 64


class Hit(NamedTuple):
    """A candidate: its key, where it begins, and where the text after it begins."""

    key: str
    start: int
    end: int


_WORD_LEFT = regex.compile(rf"(?r)[^\s\p{{P}}\p{{S}}\p{{Z}}]{{0,{LONGEST}}}")
_WORD_RIGHT = regex.compile(rf"[^\s\p{{P}}\p{{S}}\p{{Z}}]{{0,{LONGEST}}}")


def _before(text: str, at: int) -> str:
    return _WORD_LEFT.match(text, 0, at)[0]


def _after(text: str, at: int) -> str:
    return _WORD_RIGHT.match(text, at)[0]


def _class(*names: str) -> str:
    return "[" + "".join(python_class(GROUPS[n]) for n in names) + "]"


def _touching_pattern() -> regex.Pattern:
    """Marks that touch the next word. What is no fault comes first in the alternation and
    is passed over: addresses, abbreviations, decimal points, and marks between two
    characters of scripts that need no space."""
    mark, close = "[" + regex.escape(MARKS) + "]", "[" + regex.escape(CLOSERS) + "]*"
    dense = [_class("han", "kana"), *(_class(n) for n in GROUPS if n not in ("han", "kana", "hangul"))]
    passed = [
        r"(?i:(?:https?://|www\.)\S+)",
        r"(?<![^\s@])[^\s@]+@(?:[^\s@.]+\.)+[^\s@.]{2,}",
        r"(?:[A-Za-z]\.){2,}",
        r"(?<=\p{Nd})\.",
        *(rf"(?<={c}){mark}{close}(?={c})" for c in dense),
    ]
    return regex.compile("|".join(passed) + rf"|(?P<hit>{mark}{close})(?=[\p{{L}}\p{{N}}])")


_TOUCHING = _touching_pattern()


def missing_spaces(text: str) -> list[Hit]:
    """A mark (with closing quotes or brackets) that touches the next word."""
    found = (m.span() for m in _TOUCHING.finditer(text) if m["hit"])
    return [Hit(_before(text, a).casefold() + text[a:b] + _after(text, b).casefold(), a, b) for a, b in found]


_LETTER_DIGIT = regex.compile(r"(?<=\p{L})(?=\p{Nd})")


def letter_digits(text: str) -> list[Hit]:
    """A letter directly before a digit, unless both words are short."""
    out, done = [], 0
    for m in _LETTER_DIGIT.finditer(text):
        at = m.start()
        left, right = _before(text, at), _after(text, at)
        if at >= done and (len(left) >= 3 or len(right) >= 2):
            out.append(Hit(f"{left.casefold()}|{right}", at, at))
            done = at + len(right)
    return out


# Prefixes of speaker labels.
LABEL_WORDS = ("speaker", "spk", "spkr", "s", "sp", "спикер")
_LABEL_WORD = "(?:" + "|".join(LABEL_WORDS) + ")"
_LABELS = regex.compile(rf"(?i)\[[^\]\n]*\]\s*:|\[\s*{_LABEL_WORD}[^\]\n]*\]|\b{_LABEL_WORD} ?\d+\s*:")
_SPACE = regex.compile(r"(?<=\p{Nd}) (?=\p{Latin})|(?<=\p{Latin}) (?=\p{Nd})")


def digit_letter_spaces(text: str) -> list[Hit]:
    """A single space between a digit and a Latin letter, outside labels."""
    labels = [m.span() for m in _LABELS.finditer(text)]
    places = (m.start() for m in _SPACE.finditer(text))
    return [
        Hit(f"{_before(text, k).casefold()} {_after(text, k + 1).casefold()}", k, k + 1)
        for k in places
        if not any(a <= k < b for a, b in labels)
    ]


# Marks that may stand in a pair; pairs that are customary.
PAIR_MARKS = ".,;:!?。，；：！？、·…．"
CUSTOMARY = ("!!", "??", "!?", "?!", "..")
_PAIR = regex.compile(rf"([{regex.escape(PAIR_MARKS)}])[ \t]*([{regex.escape(PAIR_MARKS)}])")


def double_marks(text: str) -> list[Hit]:
    """Two marks beside each other, perhaps with white space between them."""
    return [Hit(m[0], *m.span()) for m in _PAIR.finditer(text) if m[1] + m[2] not in CUSTOMARY]


class Kind(NamedTuple):
    """How candidates of a kind are found, judged and mended."""

    scan: Callable[[str], list[Hit]]
    reach: int  # characters of context on either side
    yes: str
    no: str
    question: str
    mend: Callable[[str, Hit, object], tuple[str, int, int]]  # (new text, from, to)


_ANSWER = 'Answer with one JSON object that maps every number to "{yes}" or "{no}".'
KINDS = {
    "missing_space": Kind(
        missing_spaces, 30, "YES", "NO",
        "In each snippet a mark touches what follows it at ▸. Does a space belong there? YES at the end of a sentence or clause; NO in "
        "abbreviations, numbers, compounds and where the language writes none. " + _ANSWER,
        lambda text, h, v: (" ", h.end, h.end),
    ),
    "letter_digit": Kind(
        letter_digits, 30, "INSERT", "KEEP",
        "In each snippet a letter and a digit meet at ▸. INSERT where a word and a number were run together; KEEP names, versions, units and "
        "codes. " + _ANSWER,
        lambda text, h, v: (" ", h.start, h.start),
    ),
    "digit_letter": Kind(
        digit_letter_spaces, 30, "REMOVE", "KEEP",
        "In each snippet a space stands between a digit and a letter at ▸. REMOVE where both are one unit, version, code or board square; KEEP "
        "where the space is natural. " + _ANSWER,
        lambda text, h, v: ("", h.start, h.end),
    ),
    "double_mark": Kind(
        double_marks, 25, "", "",
        "In each snippet two marks stand between ▸ and ◂. What should stand there instead? Keep the stronger mark where one is too many, or "
        "both where that is meant. Answer with one JSON object that maps every number to the replacement.",
        lambda text, h, v: (str(v), h.start, h.end),
    ),
}
SCANS = {k: v.scan for k, v in KINDS.items()}


def candidates(df: DataFrame, id_col: str, text_col: str, kind: str) -> DataFrame:
    """(id, pos, key): every candidate of a kind."""
    scan = KINDS[kind].scan

    def kernel(columns: dict) -> dict:
        hits = [(i, h.start, h.key) for i, t in zip(columns[id_col], columns[text_col]) for h in scan(t)]
        return dict(zip((id_col, "pos", "key"), map(list, zip(*hits)))) if hits else {id_col: [], "pos": [], "key": []}

    rows = df.select(id_col, text_col).filter(F.col(text_col).isNotNull())
    return map_columns(rows, kernel, f"{id_col} bigint, pos int, key string")


_EXAMPLE = "struct<id:bigint,pos:int,left:string,mark:string,right:string>"


def patterns(df: DataFrame, id_col: str, text_col: str, kind: str) -> DataFrame:
    """(key, n, examples): occurrences of every key and its first three, with contexts.
    Tasks count by key and keep three examples before anything is shuffled; a key's
    partial rows then meet in parts, and the parts' threes last."""
    rule = KINDS[kind]

    def kernel(batches: Iterator[dict]) -> Iterator[dict]:
        held: dict[str, list] = {}

        def out() -> dict:
            rows = [(k, n, ex) for k, (n, ex) in held.items()]
            held.clear()
            return {"key": [r[0] for r in rows], "n": [r[1] for r in rows], "examples": [r[2] for r in rows]}

        for columns in batches:
            for i, text in zip(columns[id_col], columns[text_col]):
                for h in rule.scan(text):
                    mine = held.setdefault(h.key, [0, []])
                    mine[0] += 1
                    example = {
                        "id": i, "pos": h.start, "left": text[max(0, h.start - rule.reach) : h.start],
                        "mark": text[h.start : h.end], "right": text[h.end : h.end + rule.reach],
                    }
                    if len(mine[1]) < EXAMPLES or (i, h.start) < (mine[1][-1]["id"], mine[1][-1]["pos"]):
                        mine[1] = sorted([*mine[1], example], key=lambda e: (e["id"], e["pos"]))[:EXAMPLES]
            if len(held) >= HELD_KEYS:
                yield out()
        yield out()

    rows = df.select(id_col, text_col).filter(F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    partial = map_partition(rows, kernel, f"key string, n bigint, examples array<{_EXAMPLE}>")
    first = lambda c: F.slice(F.array_sort(F.flatten(F.collect_list(c))), 1, EXAMPLES)
    salt = F.pmod(F.xxhash64("key", F.col("examples")[0]["id"]), F.lit(EXAMPLE_SALTS))
    parts = partial.groupBy("key", salt.alias("salt")).agg(F.sum("n").alias("n"), first("examples").alias("examples"))
    return parts.groupBy("key").agg(F.sum("n").alias("n"), first("examples").alias("examples"))


def ranked(found: DataFrame) -> DataFrame:
    """Patterns by falling count, ties by first appearance."""
    first = F.col("examples")[0]
    return found.orderBy(F.desc("n"), first["id"], first["pos"])


# ---------------------------------------------------------------- judging

#: Keys in one question, and questions asked again for keys without an answer.
BATCH, ROUNDS = 50, 3


def snippet(kind: str, example: dict, minimal: bool = False) -> str:
    """The example that a question shows; the minimal form is two words a side."""
    left, right = example["left"], example["right"]
    if minimal:
        left, right = " ".join(left.split()[-2:])[-15:], " ".join(right.split()[:2])[:15]
    else:
        left, right = left[-10:], right[:10]
    if kind == "double_mark":
        return f"{left}▸{example['mark']}◂{right}"
    return f"{left}{'' if kind == 'digit_letter' else example['mark']}▸{right}"


def judge_prompt(kind: str, items: list[tuple[str, dict]], minimal: bool = False) -> str:
    """One question about several keys (key, example), numbered from 1."""
    rule = KINDS[kind]
    show = (lambda key: f" key={key!r}") if kind == "double_mark" else (lambda key: "")
    rows = [f'{n}.{show(key)} "{snippet(kind, example, minimal)}"' for n, (key, example) in enumerate(items, 1)]
    return "\n".join([rule.question.replace("{yes}", rule.yes).replace("{no}", rule.no), "", *rows])


def read_verdicts(kind: str, answer: str | None, keys: list[str]) -> list[str | None]:
    """A verdict per key of a question; None for all where the answer is no JSON object.
    An unknown word counts as the verdict that changes nothing."""
    try:
        told = json.loads(answer or "")
    except ValueError:
        return [None] * len(keys)
    if not isinstance(told, dict):
        return [None] * len(keys)
    rule = KINDS[kind]
    if kind == "double_mark":
        return [v if isinstance(v := told.get(str(n)), str) else key for n, key in enumerate(keys, 1)]
    return [rule.yes if str(told.get(str(n), "")).strip().upper() == rule.yes else rule.no for n in range(1, len(keys) + 1)]


class Refused(Exception):
    """The service will not take a question as it stands."""


def judge_batch(client, kind: str, items: list[tuple[str, dict]], rounds: int = ROUNDS) -> list[str]:
    """A verdict per key: asked again where no answer could be read, with less context
    where the question was refused; what stays open changes nothing if refused, else is
    ``UNRESOLVED``."""
    keys = [k for k, _ in items]
    verdicts: list[str | None] = [None] * len(keys)
    refused = False
    for _ in range(rounds + 1):
        try:
            verdicts = read_verdicts(kind, client.complete(judge_prompt(kind, items, refused), 0.0), keys)
        except Refused:
            refused = True
        except OSError:  # time outs and lost connections
            pass
        if None not in verdicts:
            break
    still = (lambda key: key if kind == "double_mark" else KINDS[kind].no) if refused else (lambda key: "UNRESOLVED")
    return [still(k) if v is None else v for k, v in zip(keys, verdicts)]


def judge(found: DataFrame, kind: str, make_client: Callable, known: DataFrame | None = None, batch: int = BATCH) -> DataFrame:
    """(key, verdict) of all patterns: those of ``known`` are taken over and not asked
    again; the others are asked in questions of ``batch`` keys, one client a task."""
    fresh = found
    if known is not None:
        known = known.filter("verdict <> 'UNRESOLVED'").select("key", "verdict")
        fresh = found.join(known, "key", "left_anti")

    def kernel(columns: dict, client) -> dict:
        items = [(k, (e or [{"left": "", "mark": "", "right": ""}])[0]) for k, e in zip(columns["key"], columns["examples"])]
        got = [v for a in range(0, len(items), batch) for v in judge_batch(client, kind, items[a : a + batch])]
        return {"key": columns["key"], "verdict": got}

    asked = map_columns(fresh.select("key", "examples"), kernel, "key string, verdict string", make_client)
    return asked if known is None else known.unionByName(asked)


class SeededJudge:
    """Deterministic client for judge questions: a verdict depends on its snippet alone."""

    def __init__(self, kind: str):
        self.kind = kind

    def complete(self, prompt: str, temperature: float = 0.0) -> str:
        from lectern.operators.model import seeded

        rule, out = KINDS[self.kind], {}
        for m in regex.finditer(r'(?m)^(\d+)\.(?: key=.*?)? "(.*)"$', prompt):
            say, shown = seeded(m[2]) < 0.5, m[2].split("▸")[-1]
            if self.kind == "double_mark":
                out[m[1]] = shown[:1] if say else shown.split("◂")[0]
            else:
                out[m[1]] = rule.yes if say else rule.no
        return json.dumps(out, ensure_ascii=False)


def write_verdicts(verdicts: DataFrame, path: str) -> None:
    """One JSON record a key."""
    verdicts.select(F.to_json(F.struct("key", "verdict")).alias("value")).write.mode("overwrite").text(path)


def load_verdicts(spark, path: str, whole: bool = False) -> DataFrame:
    """(key, verdict) of one JSON record a key, or (``whole``) of files that hold one
    object with a map ``verdicts``; open verdicts and broken records are left out."""
    raw = spark.read.text(path, wholetext=whole)
    if whole:
        rows = raw.select(F.explode(F.from_json("value", "verdicts map<string,string>")["verdicts"]).alias("key", "verdict"))
    else:
        rows = raw.select(F.from_json("value", "key string, verdict string").alias("r")).select("r.key", "r.verdict")
    return rows.filter("key IS NOT NULL AND verdict IS NOT NULL AND verdict <> 'UNRESOLVED'")


# ---------------------------------------------------------------- application


def apply_text(text: str, kind: str, verdicts) -> tuple[str, int]:
    """(mended text, places mended): keys whose verdict asks for a change, from the right."""
    rule, fixes = KINDS[kind], 0
    for h in reversed(rule.scan(text)):
        verdict = verdicts.get(h.key)
        wanted = verdict is not None and verdict != h.key if kind == "double_mark" else verdict is True or verdict == rule.yes
        if wanted:
            new, a, b = rule.mend(text, h, verdict)
            text, fixes = text[:a] + new + text[b:], fixes + 1
    return text, fixes


#: Verdicts that may be sent to all tasks.
SENT_VERDICTS = 200_000


def apply_joined(df: DataFrame, id_col: str, text_col: str, kind: str, verdicts: DataFrame) -> DataFrame:
    """(id, text, fixes) of the lines that a verdict changes, for verdicts (key, verdict)
    of any number. The verdicts that ask for a change are written once and counted: as
    many as may be sent go to the tasks that read the lines, and nothing is shuffled; more
    are joined with the keys of the lines, of which only those with a candidate move."""
    rule = KINDS[kind]
    asks = F.col("verdict") != F.col("key") if kind == "double_mark" else F.col("verdict") == rule.yes
    wanted = cut(verdicts.filter(asks).select("key", "verdict"))
    rows = df.select(id_col, text_col).filter(F.col(text_col).isNotNull())
    schema = f"{id_col} bigint, text string, fixes int"
    sent = None
    if wanted.count() <= SENT_VERDICTS:
        sent = df.sparkSession.sparkContext.broadcast({r.key: r.verdict for r in wanted.collect()})
    else:
        rows = _with_keys(rows, id_col, text_col, kind)
        held = salted(rows.select(id_col, F.explode("keys").alias("key")), wanted, "key", (id_col,))
        told = held.groupBy(id_col).agg(F.map_from_entries(F.collect_set(F.struct("key", "verdict"))).alias("told"))
        rows = rows.drop("keys").join(told, id_col)

    def kernel(columns: dict) -> dict:
        maps = (dict(t) for t in columns["told"]) if sent is None else itertools.repeat(sent.value)
        got = [(i, *apply_text(t, kind, m)) for i, t, m in zip(columns[id_col], columns[text_col], maps)]
        got = [g for g in got if g[2]]
        return {id_col: [g[0] for g in got], "text": [g[1] for g in got], "fixes": [g[2] for g in got]}

    return map_columns(rows, kernel, schema)


def _with_keys(rows: DataFrame, id_col: str, text_col: str, kind: str) -> DataFrame:
    """(id, text, keys) of the lines that hold a candidate."""
    scan = KINDS[kind].scan

    def kernel(columns: dict) -> dict:
        got = [(i, t, sorted({h.key for h in scan(t)})) for i, t in zip(columns[id_col], columns[text_col])]
        got = [g for g in got if g[2]]
        return {id_col: [g[0] for g in got], text_col: [g[1] for g in got], "keys": [g[2] for g in got]}

    return map_columns(rows, kernel, f"{id_col} bigint, {text_col} string, keys array<string>")


# ---------------------------------------------------------------- speaker labels

_NAMED = regex.compile(r"\[([^\[\]\n]*?)(\w+?)( ?)(\d+)([^\[\]\n]*)\]")


def label_forms(text: str) -> dict[str, str]:
    """Label without space, in lower case, to its form; the spaced form wins."""
    out: dict[str, str] = {}
    for m in _NAMED.finditer(text):
        key, form = (m[2] + m[4]).lower(), m[2] + m[3] + m[4]
        if key not in out or m[3]:
            out[key] = form
    return out


def unspace_labels(text: str, forms: dict[str, str]) -> str:
    """Labels written with a space lose it unless the source has it."""

    def one(m):
        key = (m[2] + m[4]).lower()
        return m[0] if not m[3] or " " in forms.get(key, "") else f"[{m[1]}{m[2]}{m[4]}{m[5]}]"

    return _NAMED.sub(one, text)
