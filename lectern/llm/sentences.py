"""Sentence boundaries across languages and scripts.

A linear chain over the places where a sentence may end (end marks with the
closing quotes and brackets behind them, and white space after Thai, which has no
end marks) tags each place as boundary or inside and is decoded by Viterbi. The
weights are a structured perceptron's, averaged, learned from a bounded sample of
rows whose punctuation step lists the sentence ends it added; every training text
is also seen in lower case and upper case, closed up, and, in the script that has no
end marks (Thai), stripped of all punctuation, so that the words on both sides decide
where case or marks tell nothing. Stretches of other scripts that no end mark closes can
be read by a second chain over the gaps between words, trained on stripped text.

Defined results
---------------
* null and blank texts give no sentence; the end of the text ends one;
* a speaker label opens the sentence after it;
* places inside hosts, addresses and decimal numbers are no candidates;
* repeated rows are split one by one; extra columns are ignored.
"""

from __future__ import annotations

import re
import sys
import unicodedata

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.sample import bounded
from lectern.llm.turns import FILLER, LABEL, SOUND, STAMP, is_label
from lectern.operators.arrow import map_columns

#: Bound of the labelled sample: distinct texts.
SAMPLE_ROWS = 10_000
EPOCHS = 5
#: Rows of the sample that the chain over word gaps sees.
BARE_ROWS = 5000
#: Longest texts of the sample, and of those that the chain over word gaps sees (without
#: their punctuation, and without brackets, which strip to nothing).
SAMPLE_CHARS, BARE_CHARS = 4000, 1500
BARE_EPOCHS = 16

_THAI = "ก-ฺเ-๎"
_CLOSE = "\"'”’»›)）\\]」』】》〉“"
_PLACE = re.compile(
    rf"[.!?…。！？｡．؟۔।॥‼⁇⁈⁉]+(?:[ \xa0 ]?[!?]+)?[{_CLOSE}]*|(?<=[{_THAI}])[{_CLOSE}]*(?=\s)|(?<=[{_THAI}][\"”’)])(?=\s)|\n"
)
_HOST = re.compile(r"(?:https?://|www\.)[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*(?:/[A-Za-z0-9\-_/.?=&%]*[A-Za-z0-9/])?|[\w.+\-]+@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)+")
_BEFORE = re.compile(r"[^\W\d_][^\W\d_̀-ͯ]*$|\d+$|[^\W_]+$")
_NEXT = re.compile(r"[^\W_]+")
_DENSE = re.compile("[㐀-鿿぀-ヿ฀-๿]")


_WIDE = re.compile("[\xa0\u2000-\u200a\u202f\u3000\uff10-\uff19\uff21-\uff3a\uff41-\uff5a]")
_PLAIN = {0xA0: " ", 0x202F: " ", 0x3000: " ", **dict.fromkeys(range(0x2000, 0x200B), " "), **{c: chr(c - 0xFEE0) for r in ((0xFF10, 0xFF1A), (0xFF21, 0xFF3B), (0xFF41, 0xFF5B)) for c in range(*r)}}


def _token_before(text: str, at: int) -> str:
    k = at
    while k > 0 and at - k < 14 and (text[k - 1].isalnum() or "̀" <= text[k - 1] <= "ͯ" or "ऀ" <= text[k - 1] <= "๿"):
        k -= 1
    w = text[k:at]
    return w[-3:] if w and _DENSE.search(w[-1]) else w


_NOT_LABEL = re.compile(r"<v |<speaker|\[[^\]\n]*\]\s?[:：]", re.IGNORECASE)


def _skip_noise(text: str, at: int) -> int:
    """Place of the next word: white space, sounds, time stamps and fillers are passed
    over, labels are not."""
    n = len(text)
    while True:
        while at < n and text[at].isspace():
            at += 1
        if at >= n:
            return at
        m = SOUND.match(text, at) if text[at] in "[<(*_♪♫" and not _NOT_LABEL.match(text, at) else None
        m = m or (STAMP.match(text, at) if text[at] in "[<({0123456789" else None) or FILLER.match(text, at)
        if not m or m.end() == at:
            return at
        at = m.end()


def _token_after(text: str, at: int) -> tuple[str, int]:
    n, k = len(text), at
    while k < n and text[k].isspace():
        k += 1
    begin = k
    k = start = _skip_noise(text, k)
    while k < n and k - start < 12 and (text[k].isalnum() or "ऀ" <= text[k] <= "๿"):
        k += 1
    w = text[start:k]
    if w and _DENSE.search(w[0]):
        w = w[:3]
    return (w or text[start : start + 1]), begin


def _kind(ch: str) -> str:
    if not ch:
        return "end"
    if ch.isdigit():
        return "digit"
    if ch.isalpha():
        return "upper" if ch.isupper() else "lower" if ch.islower() else "other"
    return ch


def _quotes(text: str) -> list[tuple[int, int]]:
    """(position, depth change) of quotation marks and brackets; plain quotes alternate."""
    out, plain, low = [], 0, 0
    for m in re.finditer('["“”„«»「」『』（）()]', text):
        c = m[0]
        if c == '"':
            plain ^= 1
            out.append((m.start(), 1 if plain else -1))
        elif c == "“" and low:
            low = 0
            out.append((m.start(), -1))
        else:
            low = 1 if c == "„" else 0 if c == "”" else low
            out.append((m.start(), 1 if c in "“„«「『（(" else -1))
    return out


def places(text: str) -> list[tuple[int, list[str], int]]:
    """(offset after the place, features, words since the last place) per candidate."""
    if not text.strip():
        return []
    if _WIDE.search(text):
        text = text.translate(_PLAIN)  # offsets stay: one character for one
    hosts = [(m.start(), m.end()) for m in _HOST.finditer(text)] if "www" in text or "@" in text or "http" in text else []
    quotes = _quotes(text)
    cased = text != text.lower() and text != text.upper()
    out, depth, q, h, last = [], 0, 0, 0, 0
    for m in _PLACE.finditer(text):
        a, b = m.span()
        if text[a:b] == "\n" and (not out or out[-1][0] >= len(text[:a].rstrip())):
            continue
        if text[a:b] == "\n":
            b = len(text[:a].rstrip())
            if b <= last:
                continue
            a = b
        while h < len(hosts) and hosts[h][1] <= a:
            h += 1
        if h < len(hosts) and hosts[h][0] <= a < hosts[h][1]:
            continue
        while q < len(quotes) and quotes[q][0] < a:
            depth += quotes[q][1]
            q += 1
        level, k = depth, q
        while k < len(quotes) and quotes[k][0] < b:
            if quotes[k][1] > 0:
                b = quotes[k][0]  # an opening quote belongs to the next sentence
                break
            level += quotes[k][1]
            k += 1
        mark = text[a:b]
        after = text[b : b + 1]
        if mark == "." and after.isdigit() and text[a - 1 : a].isdigit():
            continue  # decimal number or version
        inside = depth
        while q < len(quotes) and quotes[q][0] < b:
            depth += quotes[q][1]
            q += 1
        word = _token_before(text, a)
        follow, begin = _token_after(text, b)
        low, nxt = word.lower(), follow.lower()
        gap = "n" if b < len(text) and "\n" in text[b:begin] else "s" if begin > b else "0"
        kind = _kind(follow[:1])
        closers = mark.lstrip(".!?…。！？｡．؟۔।॥‼⁇⁈⁉ \xa0 ")
        stem = mark[: len(mark) - len(closers)]
        stem = "…" if stem[:1] == "…" or stem[:3] == "..." else stem[-1:] if stem else "T" if after != "\n" and gap != "n" else "N"
        size = min(len(word), 4)
        words = min(3, text.count(" ", last, a)) if not _DENSE.search(word[-1:] or " ") else min(3, (a - last) // 4)
        own = "n" if word[:1].isdigit() else "u" if word[:1].isupper() else "l"
        note = "c" if closers else "-"
        tail = f"{kind}{gap}{'C' if cased else 'c'}"
        feats = [
            f"m{stem}",
            f"m{stem}|{tail}",
            f"m{stem}|{note}|{inside > 0}|{depth > 0}",
            f"q{inside > 0}{depth > 0}{note}|{kind}",
            f"q{inside > 0}{depth > 0}{note}|{nxt}",
            f"w{stem}|{low}",
            f"w{stem}|{low}|{tail}",
            f"w{stem}|{low}|{nxt}",
            f"f{stem}|{nxt}",
            f"f{stem}|{nxt}|{kind}",
            f"z{stem}|{size}{own}|{tail}",
            f"d{stem}|{words}|{kind}",
            f"e{stem}|{words}|{low if words < 2 else ''}",
            f"c{closers}|{tail}",
            f"g{stem}|{gap}|{depth > 0}",
        ]
        out.append((b, feats, words))
        last = b
    return out


_NOISE = re.compile(r"[\[<(*_♪♫{]|\d:\d\d")
_MARKED = re.compile(r"[.!?…。！？｡؟।॥](?=[\s\"'”’»)\]」』）]|$)|[。！？।]")
_PIECE = re.compile("[㐀-鿿぀-ヿ฀-๿]|[^\\W㐀-鿿぀-ヿ฀-๿]+")


def gaps(text: str) -> list[tuple[int, list[str], int]]:
    """Candidates of a text without end marks: the place after every word (after every
    character where words have no spaces), with the words on both sides."""
    noise = sorted(m.span() for p in (STAMP, SOUND) for m in p.finditer(text)) if _NOISE.search(text) else []
    labels = [m.span() for m in LABEL.finditer(text) if is_label(m, text)] if ":" in text or "：" in text or "<" in text else []
    plain = text.translate(_PLAIN) if _WIDE.search(text) else text
    for a, b in (*noise, *labels):
        plain = plain[:a] + " " * (b - a) + plain[b:]
    parts = [(m.start(), m.end(), m[0].lower()) for m in _PIECE.finditer(plain)]
    out, since = [], 0
    for k in range(len(parts) - 1):
        (a, b, w), (c, _, n) = parts[k], parts[k + 1]
        since += 1
        dense = _DENSE.match(w) is not None
        if dense and c == b:
            w, n = "".join(p[2] for p in parts[max(0, k - 2) : k + 1]), "".join(p[2] for p in parts[k + 1 : k + 4])
            before, after = w[-2:], n[:2]
        else:
            before = parts[k - 1][2] + " " + w if k else w
            after = n + " " + parts[k + 2][2] if k + 2 < len(parts) else n
        joint = "0" if c == b else "s"
        size = min(since, 12) // (3 if dense else 1)
        upper = text[c : c + 1].isupper()
        feats = ["g" + joint, f"W{w}", f"N{n}", f"B{before}", f"A{after}", f"J{w}|{n}", f"L{size}{dense}", f"E{w[-3:]}|{n[:3]}", f"U{upper}{text[a:b][:1].isupper()}"]
        out.append((b, feats, min(3, since // 3)))
    return out


def stripped(text: str, ends: list[int]) -> tuple[str, list[int]]:
    """The text as unpunctuated speech: lower case, without marks outside words; ends
    move with it."""
    keep, places, out = [], {}, 0
    cut = set(ends)
    for k, c in enumerate(text):
        if k in cut:
            places[k] = out
        inner = c in ".,:'’-" and 0 < k < len(text) - 1 and text[k - 1].isalnum() and text[k + 1].isalnum() and text[k - 1].isascii() and text[k + 1].isascii()
        if c.isalnum() or c.isspace() or inner or unicodedata.category(c)[0] == "M":
            keep.append(c.lower() if len(c.lower()) == 1 else c)
            out += 1
    places[len(text)] = out
    return "".join(keep), [places.get(e, out) for e in ends]


class Chain:
    """Weights of the chain: emission differences and transitions by distance."""

    def __init__(self):
        self.weights: dict[str, float] = {}
        self.bare: Chain | None = None  # for texts without end marks
        self.bias = 0.0  # what every place gains as a boundary

    def scores(self, cands) -> list[float]:
        w = self.weights
        return [self.bias + sum(w.get(f, 0.0) for f in feats) for _, feats, _ in cands]

    def decode(self, cands) -> list[bool]:
        """Viterbi over two tags; the place before the first counts as a boundary."""
        if not cands:
            return []
        w = self.weights
        emit = self.scores(cands)
        back: list[tuple[bool, bool]] = []
        no, yes = float("-inf"), 0.0
        for e, (_, _, d) in zip(emit, cands):
            stay, start = no + w.get(f"t00{d}", 0.0), yes + w.get(f"t10{d}", 0.0)
            close, again = no + w.get(f"t01{d}", 0.0) + e, yes + w.get(f"t11{d}", 0.0) + e
            back.append((start >= stay, again >= close))
            no, yes = max(stay, start), max(close, again)
        tag, out = yes >= no, []
        for from_no, from_yes in reversed(back):
            out.append(tag)
            tag = from_yes if tag else from_no
        return out[::-1]

    def fit(self, data: list[tuple[list, list[bool]]], epochs: int = EPOCHS) -> "Chain":
        """Averaged structured perceptron."""
        import random

        total: dict[str, float] = {}
        seen: dict[str, int] = {}
        step, rng = 0, random.Random(5)
        w = self.weights

        def add(f: str, v: float) -> None:
            total[f] = total.get(f, 0.0) + w.get(f, 0.0) * (step - seen.get(f, 0))
            seen[f] = step
            w[f] = w.get(f, 0.0) + v

        for _ in range(epochs):
            rng.shuffle(data)
            for cands, gold in data:
                step += 1
                guess = self.decode(cands)
                if guess == gold:
                    continue
                gp = pp = True
                for (_, feats, d), g, p in zip(cands, gold, guess):
                    if g != p:
                        for f in feats:
                            add(f, 1.0 if g else -1.0)
                    if (gp, g) != (pp, p):
                        add(f"t{gp:d}{g:d}{d}", 1.0)
                        add(f"t{pp:d}{p:d}{d}", -1.0)
                    gp, pp = g, p
        for f in list(w):
            add(f, 0.0)
            w[f] = total[f] / max(1, step)
        self.weights = {f: round(v, 4) for f, v in w.items() if abs(v) > 1e-3}
        return self


def labelled_ends(text: str, edits: list) -> list[int] | None:
    """Sentence ends that a punctuation step lists, or None if they don't fit the text."""
    at, ends = 0, []
    for pair in edits:
        if len(pair) != 2 or not pair[1]:
            return None
        k = text.find(pair[1], at)
        if k < 0:
            return None
        at = k + len(pair[1])
        ends.append(at)
    return ends if ends and ends[-1] == len(text.rstrip()) else None


def _same_length(text: str, change) -> str:
    return "".join(x if len(x) == 1 else c for c, x in ((c, change(c)) for c in text))


def _closed_up(text: str, ends: list[int]) -> tuple[str, list[int]]:
    """The text without the space after every other sentence, as some sources write."""
    out, moved, at = [], [], 0
    for k, end in enumerate(ends):
        out.append(text[at:end])
        moved.append(sum(map(len, out)))
        at = end
        if k % 2 == 0 and text[end : end + 1] == " " and not _THAI_END.search(text[:end]):
            at += 1
    return "".join(out) + text[at:], moved


_THAI_END = re.compile(f"[{_THAI}][\"”’)]?$")


def training_data(rows: list[tuple[str, list]]) -> list[tuple[list, list[bool]]]:
    data = []
    for text, edits in rows:
        ends = labelled_ends(text, edits)
        if ends is None:
            continue
        versions = [(text, ends), (_same_length(text, str.lower), ends), (_same_length(text, str.upper), ends), _closed_up(text, ends)]
        if _THAI_END.search(text[: ends[0]]):  # a script without end marks is learned without any mark
            versions.append(stripped(text, ends))
        for version, ends in versions:
            cands = places(version)
            known = {c[0] for c in cands}
            if set(ends) - {len(version.rstrip())} <= known:
                data.append((_shared(cands), [c[0] in ends for c in cands]))
    return data


def _shared(cands: list[tuple[int, list[str], int]]) -> list[tuple[int, list[str], int]]:
    """Candidates with one copy of every feature's name, which many share."""
    return [(at, list(map(sys.intern, feats)), d) for at, feats, d in cands]


def bare_data(rows: list[tuple[str, list]]) -> list[tuple[list, list[bool]]]:
    """Stripped texts with the gaps at which a sentence ended."""
    data = []
    for text, edits in rows:
        ends = labelled_ends(text, edits)
        if ends is None or len(text) > BARE_CHARS or "[" in text:
            continue
        plain, moved = stripped(text, ends)
        cands = gaps(plain)
        at = {e for e in moved if e < len(plain.rstrip())}
        snapped = {max((c[0] for c in cands if c[0] <= e), default=0) for e in at}
        data.append((_shared(cands), [c[0] in snapped for c in cands]))
    return data


def train(df: DataFrame, bare: bool = False, most: int = SAMPLE_ROWS) -> Chain:
    """Fit on a bounded sample of at most ``most`` labelled rows, picked by the hash of
    their text."""
    rows = df.filter("corrected_text IS NOT NULL AND size(ct_punct.edits) > 0 ").filter(F.length("corrected_text") < SAMPLE_CHARS)
    picked = bounded(rows.select("corrected_text", F.col("ct_punct.edits").alias("edits")), "corrected_text", most, "corrected_text", "edits")
    rows = [(r.corrected_text, r.edits) for r in picked]
    chain = Chain().fit(training_data(rows))
    if bare:
        chain.bare = fit_bare(bare_data(rows[:BARE_ROWS]))
    return chain


#: Gains among which the chain over word gaps is calibrated.
BIASES = (0.0, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0)


def fit_bare(data: list[tuple[list, list[bool]]]) -> Chain:
    """The chain over word gaps. Boundaries are rare there, so it would rather miss than
    find them: the gain that balances both best is taken from a fifth of the data that a
    first fit does not see."""
    aside = data[::5]
    first = Chain().fit([x for k, x in enumerate(data) if k % 5], BARE_EPOCHS)

    def balance(bias: float) -> float:
        first.bias = bias
        right = told = true = 0
        for cands, gold in aside:
            guess = first.decode(cands)
            right, told, true = right + sum(map(min, guess, gold)), told + sum(guess), true + sum(gold)
        return 2 * right / max(1, told + true)

    best = max(BIASES, key=balance)
    chain = Chain().fit(data, BARE_EPOCHS)
    chain.bias = best
    return chain


_CLOSING = re.compile(rf"[.!?…。！？｡．؟۔।॥‼⁇⁈⁉][{_CLOSE}]*\s*$")


def _bare(text: str, breaks: list[int], bare: Chain) -> set[int]:
    """Ends inside a stretch without marks: those the chain over word gaps tells, line
    breaks that were taken for ends, and places where a label opens a sentence. What is
    no speech gives no sentence of its own."""
    cands = gaps(text)
    found = {c[0] for c, y in zip(cands, bare.decode(cands)) if y}
    plain = text
    for m in (m for p in (STAMP, SOUND) for m in p.finditer(text)) if _NOISE.search(text) else ():
        plain = plain[: m.start()] + " " * (m.end() - m.start()) + plain[m.end() :]
    fixed = set()
    for a in (m.start() for m in LABEL.finditer(text) if is_label(m, text)):
        line = text.rfind("\n", len(plain[:a].rstrip()), a)
        fixed.add(len(text[: line if line >= 0 else a].rstrip()))
    for end in fixed | set(breaks):
        found -= set(range(len(plain[:end].rstrip()), end))
    return found | fixed | set(breaks)


def _mostly_cased(text: str) -> bool:
    """True if most letters are of a script that has capitals."""
    return 2 * sum(c.lower() != c.upper() for c in text) > sum(map(str.isalpha, text))


def _bare_ends(text: str, ends: list[int], bare: Chain) -> list[int]:
    """``ends`` and those that word gaps tell: every stretch that no end mark closes, or
    whose letters are of one case, is read by the chain over word gaps, with its line
    breaks. Spaces after Thai are marks
    where the text has marks or lines."""
    n = len(text.rstrip())
    written = "\n" in text[:n] or _MARKED.search(text[: n - 1]) is not None
    out: set[int] = set()
    start, breaks = 0, []
    for end in [*(e for e in ends if e < n), n]:
        thai = _THAI_END.search(text, max(start, end - 2), end) is not None
        marked = written and thai or _CLOSING.search(text, max(start, end - 12), end) is not None
        if not marked and end < n:
            if text[end : len(text) - len(text[end:].lstrip())].count("\n"):
                breaks.append(end - start)
            continue
        part = text[start:end]
        flat = part in (part.lower(), part.upper()) and _mostly_cased(part)
        upto = end if not marked or (flat and not thai) else start + breaks[-1] if breaks else start
        if upto > start:
            out |= {start + e for e in _bare(text[start:upto], breaks, bare)}
        out.add(end)
        start, breaks = end, []
    return sorted(out - {0})


def sentence_ends(text: str | None, chain: Chain) -> list[int]:
    """Offsets just after every sentence of a text."""
    if not text or not text.strip():
        return []
    cands = places(text)
    ends = [c[0] for c, y in zip(cands, chain.decode(cands)) if y]
    if chain.bare is not None:
        ends = _bare_ends(text, ends, chain.bare)
    final = len(text.rstrip())
    if not ends or ends[-1] != final:
        ends = [e for e in ends if e < final] + [final]
    return ends


def units(df: DataFrame, chain: Chain) -> DataFrame:
    """(payload_id, field, sent_no, sent_start, sent_end) of ``df`` (payload_id, field, text)."""
    shared = df.sparkSession.sparkContext.broadcast(chain)

    def kernel(columns: dict) -> dict:
        out = {n: [] for n in ("payload_id", "field", "sent_no", "sent_start", "sent_end")}
        model = shared.value
        for i, field, text in zip(columns["payload_id"], columns["field"], columns["text"]):
            start = 0
            for k, end in enumerate(sentence_ends(text, model)):
                begin = start + len(text[start:end]) - len(text[start:end].lstrip())
                for n, v in zip(out, (i, field, k + 1, begin, end)):
                    out[n].append(v)
                start = end
        return out

    return map_columns(
        df.select("payload_id", "field", "text"), kernel, "payload_id bigint, field string, sent_no int, sent_start int, sent_end int"
    )
