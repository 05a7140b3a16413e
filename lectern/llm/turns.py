"""Speech transcripts into clean speaker turns.

A text is read as a sequence of segments, each opened by a speaker label and, where
given, timed. Timed segments are ordered by a sweep over their start times,
repetition of rolling captions is removed by the longest suffix of one segment that
is a prefix of the next, and turns are split at labels, or, where a label is
missing, at pauses longer than the pause calibrated over the corpus.

Defined results
---------------
* null texts and texts without a label give no turn;
* speech before the first label is a turn of ``UNK``;
* every label opens a turn, also when the speaker stays; a turn without words
  (time stamps, fillers, sounds, emoji only) is dropped and not numbered;
* a timed segment that starts within ROLLING seconds of the last one of its speaker, or
  before that one ends, and says nothing but its end, is a rolling caption and no turn;
  said again later, or without times, it is speech;
* equal start times keep the order of the text; repeated rows are read one by one;
  extra columns are ignored.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.lookalike import one_form
from lectern.operators.arrow import map_columns

_MARK = "̀-ͯऀ-ःऺ-ॏัิ-ฺ็-๎ً-ْ"
_L = rf"(?:[^\W\d_]|[{_MARK}])"
_COLON = r"\s?[:：]"
_NUMBERED = rf"{_L}{{2,}}[ _]?(?:\d{{1,3}}|[A-Z])(?!\w)"
_ANY_NUMBERED = rf"(?:{_L}+[ _]?\d{{1,3}}|{_L}{{2,}}[ _]?[A-Z])(?!\w)"
_NAME = rf"{_L}+(?:[.'’\-]{_L}+)*(?: {_L}+){{0,2}}"
_WORD = rf"{_L}+(?:['’\-]{_L}+)*"
_ROLE = r"(?: ?[(（][^()（）\n:]{1,20}[)）])?"

#: Every form of a label; the groups hold what names the speaker.
LABEL = re.compile(
    rf"(?<![\w@])(?:"
    rf"(?:>>\s?)?\*\*\s?(?P<a>{_ANY_NUMBERED}|{_NAME}){_ROLE}{_COLON}?\s?\*\*{_COLON}?"
    rf"|(?:>>\s?)?\[\s?(?P<b>{_ANY_NUMBERED}|{_NAME}){_ROLE}\s?\]{_COLON}"
    rf"|<v[ .](?P<c>[^<>\n]{{1,40}})>"
    rf"|<(?P<d>{_ANY_NUMBERED})>{_COLON}?"
    rf"|>>\s?(?P<e>{_ANY_NUMBERED}|{_NAME}){_ROLE}{_COLON}(?!\d)"
    rf"|(?P<f>{_NUMBERED}){_ROLE}{_COLON}(?![\d/])"
    rf"|(?P<g>{_WORD}){_ROLE}{_COLON}(?=\s|$|[^\W\d])"
    rf")"
)
_CLOCK = r"\d{1,3}(?::\d{2}){1,2}(?:[.,]\d{1,3})?"
_FULL = r"\d{1,2}:\d{2}:\d{2}[.,]\d{1,3}"
STAMP = re.compile(
    rf"[\[(<{{]\s?(?P<x>{_CLOCK})(?:\s*-->?\s*{_CLOCK})?\s?[\])>}}]|\{{t=(?P<t>\d+(?:\.\d+)?)\}}"
    rf"|(?<![\d:])(?P<y>{_FULL})(?:\s*-->\s*(?P<z>{_FULL}))?(?![\d:])|(?<![\d:])(?P<w>\d{{1,2}}:\d{{2}}:\d{{2}})(?:\s*-->\s*\d{{1,2}}:\d{{2}}:\d{{2}})?(?![\d:])"
)
SOUND = re.compile(
    r"\(\([^()\n]{1,30}\)\)|\[[^\[\]\n:]{1,30}\]|<[a-zA-Z/_ ]{1,20}>|\((?:laughter|laughs|applause|music|noise|cough|coughs|inaudible|crosstalk)\)"
    r"|(?<!\w)_[^\W\d_][\w ./]{0,20}_(?!\w)|\*[^*\n]{1,20}\*|[♪♫]+",
    re.IGNORECASE,
)
# Fillers of the fourteen languages; longer phrases come first.
FILLERS = (
    "you know|um|uh|uhm|er|hmm|hm|mm|mhm|erm|ah|eh|also äh|ähm|äh|öh|bah euh|euh|heu|este eh|mmm|no yyy|yyy|eee|"
    "no ehm|ehm|éé|anu|ну э-э|э-э|эм|ээ|يعني آآ|آآ|إمم|हम्म|उम्म|अं|呃嗯|呃|嗯|えーと|えっと|あのー|저기 음|음|어|เอ่อ|อืม"
)
FILLER = re.compile(rf"(?<!\w)(?:{'|'.join(sorted(FILLERS.split('|'), key=len, reverse=True))})(?!\w)[,，、。.…]*", re.IGNORECASE)
DENSE_FILLER = re.compile("呃嗯|呃|嗯|えーと|えっと|あのー|เอ่อ|อืม")
_SPEECH = re.compile(rf"\d|{_L}")
_CASED = re.compile(r"[a-zß-öø-ÿа-я]")


def speaker_of(raw: str) -> str:
    """One name per speaker: SPK and number or letter, else the bare name."""
    name = re.sub(r"\s*[(（].*$", "", raw.strip(" >*[]:：")).strip()
    m = re.fullmatch(rf"({_L}+)[ _]?(\d{{1,3}})|({_L}{{2,}})[ _]?([A-Z])", name)
    if m and m[2]:
        return f"SPK{int(m[2])}"
    if m and (" " in name or "_" in name or m[3].lower() in ("spk", "speaker", "spkr")):
        return "SPK" + m[4]
    return name.upper()


def is_label(m: re.Match, text: str) -> bool:
    if m["g"] is not None:
        word = m["g"]
        if word[:1].islower() or word.lower() in ("http", "https"):
            return False
        before = text[: m.start()].rstrip(" ")
        if not m[0][-1] in ":：" or text[m.end() : m.end() + 2] == "//":
            return False
        return not before or m.start() == 0 or text[m.start() - 1] in " \n\t\r　\xa0>*]})"
    if m["f"] is not None:
        return text[m.end() : m.end() + 2] != "//"
    return True


def seconds(clock: str) -> float:
    """Seconds of a clock value with two or three fields, or plain seconds."""
    total = 0.0
    for part in clock.replace(",", ".").split(":"):
        total = total * 60 + float(part)
    return total


_MAY_BE_NOISE = re.compile(r"[\[<(*_{♪♫]|\d:\d\d")


def bare(text: str) -> str:
    """Speech without time stamps, sounds and fillers."""
    if _MAY_BE_NOISE.search(text):
        text = SOUND.sub(" ", STAMP.sub(" ", text))
    text = DENSE_FILLER.sub("", FILLER.sub(" ", text))
    return re.sub(r"\s+", " ", text).strip()


def overlap(before: str, after: str) -> int:
    """Length of the longest suffix of ``before`` (whole words, two at least) that
    is a prefix of ``after``; by the failure function, in linear time."""
    a, b = before.split(" "), after.split(" ")
    if len(a) < 2 or len(b) < 2:
        return 0
    joined = b + [None] + a[-len(b) :]
    fail = [0] * len(joined)
    for i in range(1, len(joined)):
        k = fail[i - 1]
        while k and joined[i] != joined[k]:
            k = fail[k - 1]
        fail[i] = k + (joined[i] == joined[k])
    n = fail[-1]
    return len(" ".join(b[:n])) if n >= 2 else 0


def parse(text: str) -> tuple[list[tuple], list[str]] | None:
    """Segments (start time or None, end time or None, speaker, label end, raw
    speech) of a text in one form, and its raw labels; None without a label."""
    found = [m for m in LABEL.finditer(text) if is_label(m, text)]
    if not found:
        return None
    edges = []
    for m in found:
        start = m.start()
        lead = None
        for s in STAMP.finditer(text, max(0, start - 40), start):
            if not text[s.end() : start].strip():
                lead = s
        edges.append((lead.start() if lead else start, m.end(), m, lead))
    out = []
    head = text[: edges[0][0]]
    if _SPEECH.search(bare(head)):
        out.append((None, None, "UNK", 0, head))
    for k, (_, end, m, lead) in enumerate(edges):
        stop = edges[k + 1][0] if k + 1 < len(edges) else len(text)
        raw = next(g for g in m.groups() if g is not None)
        body = text[end:stop]
        first = lead or STAMP.match(body.lstrip())
        at = first and (first["x"] or first["y"] or first["t"] or first["w"])
        out.append((seconds(at) if at else None, seconds(first["z"]) if first and first["z"] else None, speaker_of(raw), end, body))
    return out, [m[0] for m in found]


def sweep(parts: list[tuple]) -> list[tuple]:
    """Segments by start time; untimed ones stay behind the one before them."""
    if sum(p[0] is not None for p in parts) < 2:
        return parts
    last, keyed = float("-inf"), []
    for k, p in enumerate(parts):
        last = p[0] if p[0] is not None else last
        keyed.append((last, k, p))
    return [p for _, _, p in sorted(keyed, key=lambda x: x[:2])]


def turns(text: str | None, pause: float | None = None) -> list[tuple[int, str, str, float | None]]:
    """(turn_no, speaker, speech, start time) of a text."""
    if not text or not (":" in text or "：" in text or "<" in text or "**" in text):
        return []
    read = parse(one_form(text))
    if read is None:
        return []
    out: list[tuple[int, str, str, float | None]] = []
    shown: float | None = None  # start and end of the last segment, turn or not
    until: float | None = None
    for at, end, who, _, body in sweep(read[0]):
        for piece, when in split_pauses(body, at, pause):
            speech = bare(piece)
            if not _SPEECH.search(speech):
                continue
            if out and out[-1][1] == who:
                n = overlap(out[-1][2], speech)
                again = repeats(shown, until, when)
                if n == len(speech) and again:
                    shown, until = when, end
                    continue  # a caption that only shows what the last one showed
                # a whole sentence said again is speech, and so is what comes again later
                n = 0 if n == len(speech) or again is False else n
                speech = speech[n:].lstrip() if n else speech
            out.append((len(out) + 1, who, speech, when))
            shown, until = when, end
    return out


#: Seconds within which a caption that repeats the last one is the same caption rolling on.
ROLLING = 3.0


def repeats(last: float | None, until: float | None, now: float | None) -> bool | None:
    """True if a segment starts while the last one is still shown, False if later, None
    where there are no times."""
    if last is None or now is None:
        return None
    return now - last <= ROLLING or (until is not None and now < until)


def split_pauses(body: str, at: float | None, pause: float | None):
    """Split speech under one label where the time stamps inside it leave a gap above
    the calibrated pause. Without a calibration nothing is split."""
    if pause is None or at is None:
        return [(body, at)]
    out, begin, last = [], 0, at
    for s in STAMP.finditer(body):
        now = seconds(s["x"] or s["y"] or s["t"] or s["w"])
        if now - last > pause and _SPEECH.search(bare(body[begin : s.start()])):
            out.append((body[begin : s.start()], at))
            begin, at = s.start(), now
        last = now
    return out + [(body[begin:], at)]


_SCHEMA = "payload_id bigint, turn_no int, speaker string, speech string, start_s double"


def speaker_turns(df: DataFrame, pause: float | None = None) -> DataFrame:
    """One row per turn of ``source_text``."""

    def kernel(columns: dict) -> dict:
        out = {n: [] for n in ("payload_id", "turn_no", "speaker", "speech", "start_s")}
        for i, text in zip(columns["payload_id"], columns["source_text"]):
            for row in turns(text, pause):
                for n, v in zip(out, (i, *row)):
                    out[n].append(v)
        return out

    rows = df.select("payload_id", "source_text").filter(F.col("source_text").rlike("[:：<*]"))
    return map_columns(rows, kernel, _SCHEMA)


def calibrated_pause(df: DataFrame, quantile: float = 0.99) -> float | None:
    """The pause that separates turns: a high quantile of the gaps between starts of
    neighbouring segments of one speaker, over all texts."""

    def kernel(columns: dict) -> dict:
        gaps = []
        for text in columns["source_text"]:
            read = parse(one_form(text))
            parts = sweep(read[0]) if read else []
            gaps += [q[0] - p[0] for p, q in zip(parts, parts[1:]) if p[0] is not None and q[0] is not None and p[2] == q[2]]
        return {"gap": gaps}

    rows = df.select("source_text").filter(F.col("source_text").rlike(r"\d:\d\d|\{t="))
    row = map_columns(rows, kernel, "gap double").agg(F.percentile_approx("gap", quantile, 1000)).first()
    return row[0]
