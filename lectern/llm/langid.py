"""Language labels for documents and for segments of mixed documents.

A linear-chain conditional random field labels the words of a text. The potentials of
a word come from its letters (whole word, affixes, n-grams, script) and from the
lexicons (languages whose labelled documents use it more than rarely), those of a step
from the two languages that it joins, at a sentence start and inside a sentence. All
weights are fitted jointly, by gradients of the chain's likelihood, on a bounded sample
of labelled documents, parts of which are spliced so that languages change at known
places, at sentence starts and inside sentences. Words are labelled by
forward-backward, so every word and segment has a probability.

Scripts without spaces are cut into short units. Speaker labels, sound tags, hosts,
codes and numbers are no words; look-alike letters are read as what they look like.

Defined results
---------------
* null or blank text gives no row; a text without words none either;
* a text of one language is one segment; segments are runs of words of one language;
* of equal probabilities the language first in ``LANGUAGES`` wins;
* repeated rows are labelled one by one; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.lookalike import one_form
from lectern.llm.sample import bounded
from lectern.operators.arrow import map_columns

# The languages, and names under which a locale may give them.
LANGUAGES = ("en", "de", "fr", "es", "pl", "cs", "id", "ru", "ar", "hi", "zh", "ja", "ko", "th")
NAMES = {
    "en": "en eng english englisch anglais inglés ingles angielski angličtina inggris английский",
    "de": "de deu ger german deutsch allemand alemán niemiecki němčina jerman немецкий",
    "fr": "fr fra fre french français francais französisch francés francuski francouzština prancis французский",
    "es": "es spa spanish español espanol castellano spanisch espagnol hiszpański španělština spanyol испанский",
    "pl": "pl pol polish polski polnisch polonais polaco polština polandia польский",
    "cs": "cs ces cze czech čeština cestina český tschechisch tchèque checo czeski ceko чешский",
    "id": "id in ind indonesian indonesia bahasa indonesisch indonésien indonesio indonezyjski индонезийский",
    "ru": "ru rus russian русский russisch russe ruso rosyjski ruština rusia",
    "ar": "ar ara arabic العربية عربي arabisch arabe árabe arabski arabština arab арабский",
    "hi": "hi hin hindi हिन्दी हिंदी",
    "zh": "zh zho chi cmn chinese mandarin 中文 汉语 普通话 chinesisch chinois chino chiński čínština tionghoa китайский",
    "ja": "ja jpn japanese 日本語 japanisch japonais japonés japoński japonština jepang японский jp",
    "ko": "ko kor korean 한국어 koreanisch coréen coreano koreański korejština korea корейский kr",
    "th": "th tha thai ไทย ภาษาไทย thailändisch thaï tailandés tajski thajština тайский",
}
_LOCALE = {n: code for code, names in NAMES.items() for n in names.split()}

BITS = 16
#: Bounds of the labelled sample: documents, the characters they may have, words of all.
SAMPLE_DOCUMENTS, SAMPLE_CHARS, SAMPLE_WORDS = 900, (40, 4000), 400_000
#: Uses in a language from which on a word is in its lexicon.
LEXICON_USES = 3
#: Words of a training sequence, and how often languages change in one: share of
#: sentence starts and of words inside sentences.
SEQUENCE, SPLICED = 48, (0.02, 0.0005)
MIN_LETTERS = 20


def locale_language(locale: str | None) -> str | None:
    """Language code of a locale spelled as tag, code or name; None if it is none."""
    if not locale:
        return None
    head = re.split(r"[-_\s(,;./]", locale.strip().lower(), maxsplit=1)[0]
    return _LOCALE.get(head) or _LOCALE.get(locale.strip().lower())


_SKIP = re.compile(
    r"https?://\S+|www\.[\w.\-]+(?<=[a-z])|(?<!\S)\S+@\S+\.\S+|\[[^\]\n]{1,24}\]|<[^>\n]{1,24}>|\{[^}\n]{1,24}\}|\(\([^)\n]{1,24}\)\)|\((?:laughter|host|guest)\)"
    r"|(?<!\w)_[^\W\d_][\w .]{0,20}_(?!\w)|\*+[^*\n]{1,24}\*+|(?<![^\W_])(?:speaker|spk|spkr)[ _]?(?:\d+|[a-z])?(?![^\W_])"
    r"|(?<![A-Za-z])[A-Za-z]*\d[A-Za-z\d.,:]*",
    re.IGNORECASE,
)
_UNIT = re.compile(
    "[㐀-鿿豈-﫿\U00020000-\U0003ffff々]{1,2}|[ぁ-ゟ]{1,3}|[゠-ヿ]{1,8}|[฀-๿]{1,5}|"
    "[가-힯ᄀ-ᇿ]+|[ऀ-ॿ]+|[؀-ۿݐ-ݿ]+|[Ѐ-ԯ]+|[A-Za-zª-ɏ̀-ͯḀ-ỿ]+(?:['’][A-Za-zÀ-ɏ]+)*"
)
_END = re.compile(r"[.!?。！？؟।…\n]")


def units(text: str) -> list[tuple[int, int, str, bool]]:
    """(start, end, folded unit, starts a sentence) of the words of a text in one form."""
    masked = _SKIP.sub(lambda m: " " * len(m[0]), text)
    out, last = [], 0
    for m in _UNIT.finditer(masked):
        gap = text[last : m.start()] if out else "."
        fresh = bool(_END.search(gap)) if gap else False
        out.append((m.start(), m.end(), m[0].lower(), fresh))
        last = m.end()
    return out


def features(word: str) -> list[int]:
    """Hashed features: word, script, affixes, n-grams."""
    w = f"^{word}$"
    found = {"w" + word, f"x{ord(word[0]) >> 7}"}
    for n in (1, 2, 3):
        found.add("p" + word[:n])
        found.add("s" + word[-n:])
    found |= {"b" + w[i : i + 2] for i in range(len(w) - 1)}
    found |= {"t" + w[i : i + 3] for i in range(len(w) - 2)}
    mask = (1 << BITS) - 1
    return sorted({zlib.crc32(f.encode()) & mask for f in found})


def lexicon_features(languages: tuple[int, ...]) -> list[int]:
    mask = (1 << BITS) - 1
    return [zlib.crc32(f"l{y}".encode()) & mask for y in languages]


#: Part of every word's potential that is the same for all languages.
FLOOR = 0.02


class Model:
    """Weights of words and steps, lexicons, and a cache of word potentials. ``steps`` are
    two tables (sentence start, inside) of potentials from one language to the next."""

    def __init__(self, weights, steps=None, lexicon: dict[str, tuple[int, ...]] | None = None):
        import numpy as np

        n = len(LANGUAGES)
        self.weights, self.lexicon = weights, lexicon or {}
        self.steps = np.stack([np.full((n, n), s / (n - 1)) + np.eye(n) * (1 - s - s / (n - 1)) for s in SPLICED]) if steps is None else steps
        self.cache: dict[str, int] = {}
        self.rows = None
        self.used = 0

    def __getstate__(self):
        return {"weights": self.weights, "steps": self.steps, "lexicon": self.lexicon}

    def __setstate__(self, state):
        self.__init__(state["weights"], state["steps"], state["lexicon"])

    def features(self, word: str) -> list[int]:
        known = self.lexicon.get(word)
        return features(word) + lexicon_features(known) if known else features(word)

    def ids(self, words: list[str]) -> list[int]:
        import numpy as np

        if self.rows is None or self.used > 200_000:  # the cache is bounded; it only saves time
            self.rows, self.used, self.cache = np.zeros((4096, len(LANGUAGES)), np.float32), 0, {}
        out, cache = [], self.cache
        for w in words:
            k = cache.get(w)
            if k is None:
                k = cache[w] = self.used
                if k >= len(self.rows):
                    self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
                z = self.weights[self.features(w)].sum(0)
                z = z - z.max()
                p = np.exp(z)
                self.rows[k] = p / p.sum()
                self.used += 1
            out.append(k)
        return out

    def marginals(self, texts: list[list[tuple]]) -> list:
        """Per text an array (words, languages) of marginal probabilities."""
        import numpy as np

        out: list = [None] * len(texts)
        order = sorted((k for k in range(len(texts)) if texts[k]), key=lambda k: len(texts[k]))
        n = len(LANGUAGES)
        at = 0
        while at < len(order):
            longest = len(texts[order[min(len(order) - 1, at + 127)]])
            take = max(1, min(128, 200_000 // max(1, longest)))
            part = order[at : at + take]
            at += take
            width = len(texts[part[-1]])
            emit = np.full((len(part), width, n), 1.0 / n, np.float64)
            kind = np.ones((len(part), width), np.int8)
            for r, k in enumerate(part):
                ids = self.ids([u[2] for u in texts[k]])
                emit[r, : len(ids)] = self.rows[ids]
                kind[r, : len(ids)] = [0 if u[3] else 1 for u in texts[k]]
            fwd, bwd = passes(emit * (1 - FLOOR) + FLOOR / n, kind, self.steps)
            post = fwd * bwd
            post /= post.sum(2, keepdims=True)
            for r, k in enumerate(part):
                out[k] = post[r, : len(texts[k])]
        return out


def passes(emit, kind, steps):
    """Forward and backward messages (rows, words, languages), each scaled to sum to one,
    of a batch of chains padded at the end; ``kind`` is 0 at sentence starts."""
    import numpy as np

    fwd, bwd = np.empty_like(emit), np.ones_like(emit)
    fwd[:, 0] = emit[:, 0] / emit[:, 0].sum(1, keepdims=True)
    back = steps.transpose(0, 2, 1)
    for t in range(1, emit.shape[1]):
        start = kind[:, t, None] == 0
        step = np.where(start, fwd[:, t - 1] @ steps[0], fwd[:, t - 1] @ steps[1]) if start.any() else fwd[:, t - 1] @ steps[1]
        step *= emit[:, t]
        fwd[:, t] = step / step.sum(1, keepdims=True)
    for t in range(emit.shape[1] - 2, -1, -1):
        start = kind[:, t + 1, None] == 0
        v = bwd[:, t + 1] * emit[:, t + 1]
        v = np.where(start, v @ back[0], v @ back[1]) if start.any() else v @ back[1]
        bwd[:, t] = v / v.sum(1, keepdims=True)
    return fwd, bwd


def spliced(sentences: list[tuple[int, list[str]]], seed: int = 11) -> list[list[tuple[str, int, bool]]]:
    """Training sequences of (word, language, starts a sentence) from the sentences of
    labelled texts in order. At a share of sentence starts, and of places inside a
    sentence, the text goes on in a sentence of another language, drawn at random."""
    import random

    rng = random.Random(seed)
    by: dict[int, list[list[str]]] = {}
    for y, words in sentences:
        by.setdefault(y, []).append(words)
    others = {y: [x for x in by if x != y] for y in by}
    out: list[list[tuple[str, int, bool]]] = [[]]

    def add(word: str, y: int, fresh: bool) -> None:
        if len(out[-1]) >= SEQUENCE:
            out.append([])
        out[-1].append((word, y, fresh))

    for y, words in sentences:
        if others[y] and rng.random() < SPLICED[0]:
            z = rng.choice(others[y])
            for k, w in enumerate(rng.choice(by[z])[:SEQUENCE]):
                add(w, z, k == 0)
        at = rng.randrange(1, len(words)) if len(words) > 1 and rng.random() < SPLICED[1] * len(words) else 0
        for k, w in enumerate(words):
            if at and k == at and others[y]:
                z = rng.choice(others[y])
                for x in rng.choice(by[z])[:SEQUENCE]:
                    add(x, z, False)
            add(w, y, k == 0)
    return [s for s in out if s]


def fit(labelled: list[tuple[str, str]], epochs: int = 12, joint: int = 3) -> Model:
    """Fit on (text, language) pairs: words alone first, for a start, then words and steps
    together on spliced sequences."""
    import numpy as np

    counts: dict[str, dict[int, int]] = {}
    sentences: list[tuple[int, list[str]]] = []
    room = SAMPLE_WORDS
    for text, lang in labelled:
        if lang not in LANGUAGES or room <= 0:
            continue
        y = LANGUAGES.index(lang)
        got = units(one_form(text))
        room -= len(got)
        for _, _, w, fresh in got:
            own = counts.setdefault(w, {})
            own[y] = own.get(y, 0) + 1
            if fresh or not sentences or sentences[-1][0] != y:
                sentences.append((y, []))
            sentences[-1][1].append(w)
    lexicon = {w: tuple(sorted(y for y, c in own.items() if c >= LEXICON_USES)) for w, own in counts.items()}
    model = Model(np.zeros((1 << BITS, len(LANGUAGES)), np.float32), None, {w: ys for w, ys in lexicon.items() if ys})
    if counts:
        words = list(counts)
        place = {w: k for k, w in enumerate(words)}
        found = [model.features(w) for w in words]
        width = max(map(len, found))
        grid = np.zeros((len(words), width), np.int32)
        mask = np.zeros((len(words), width, 1), np.float32)
        for k, r in enumerate(found):
            grid[k, : len(r)] = r
            mask[k, : len(r)] = 1
        grad2 = np.full(model.weights.shape, 1e-6, np.float32)
        _fit_words(model, [counts[w] for w in words], grid, mask, grad2, epochs)
        _fit_chain(model, [[(place[w], y, f) for w, y, f in s] for s in spliced(sentences)], grid, mask, grad2, joint)
    return model


def _descend(weights, grad2, grid, mask, d, rate: float = 0.3) -> None:
    """One AdaGrad step: ``d`` are the gradients of the words' sums."""
    import numpy as np

    n = weights.shape[1]
    keys, place = np.unique(grid, return_inverse=True)
    place = place.reshape(-1)
    live = mask.reshape(-1) > 0
    step = np.repeat(d, grid.shape[1], axis=0)[live]
    g = np.empty((len(keys), n), np.float32)
    for y in range(n):
        g[:, y] = np.bincount(place[live], weights=step[:, y], minlength=len(keys))
    grad2[keys] += g * g
    weights[keys] -= rate * g / np.sqrt(grad2[keys]) + 1e-5 * weights[keys]


def _fit_words(model: Model, counts: list[dict[int, int]], grid, mask, grad2, epochs: int) -> None:
    """Softmax regression word by word; languages count alike, however many texts they
    have, and words by the logarithm of their uses."""
    import numpy as np

    n = len(LANGUAGES)
    total = np.ones(n)
    for own in counts:
        for y, c in own.items():
            total[y] += c
    target = np.full((len(counts), n), 1e-7)
    for k, own in enumerate(counts):
        for y, c in own.items():
            target[k, y] += c / total[y]
    target = (target / target.sum(1, keepdims=True)).astype(np.float32)
    scale = np.array([1 + np.log1p(sum(own.values())) for own in counts], np.float32)
    rng = np.random.default_rng(7)
    for _ in range(epochs):
        for pick in np.array_split(rng.permutation(len(counts)), max(1, len(counts) // 256)):
            z = (model.weights[grid[pick]] * mask[pick]).sum(1)
            z = np.exp(z - z.max(1, keepdims=True))
            d = (z / z.sum(1, keepdims=True) - target[pick]) * scale[pick, None]
            _descend(model.weights, grad2, grid[pick], mask[pick], d)


def _fit_chain(model: Model, sequences: list[list[tuple[int, int, bool]]], grid, mask, grad2, epochs: int) -> None:
    """Gradient steps of the chain's conditional likelihood, over words and steps at once.
    A batch's gradient of a word is the sum over its uses of marginals less labels; that
    of a step the expected uses less those that are there."""
    import numpy as np

    n = len(LANGUAGES)
    log_steps = np.log(model.steps)
    step2 = np.full(log_steps.shape, 1e-2)
    rng = np.random.default_rng(5)
    for _ in range(epochs):
        for pick in np.array_split(rng.permutation(len(sequences)), max(1, len(sequences) // 128)):
            batch = sorted((sequences[k] for k in pick), key=len)
            wide = len(batch[-1])
            word, label = np.zeros((len(batch), wide), np.int64), np.zeros((len(batch), wide), np.int64)
            kind, live = np.ones((len(batch), wide), np.int8), np.zeros((len(batch), wide), bool)
            for r, s in enumerate(batch):
                m = len(s)
                word[r, :m], label[r, :m], live[r, :m] = [x[0] for x in s], [x[1] for x in s], True
                kind[r, :m] = [0 if x[2] else 1 for x in s]
            used, place = np.unique(word[live], return_inverse=True)
            z = (model.weights[grid[used]] * mask[used]).sum(1)
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            floor = p * (1 - FLOOR) + FLOOR / n
            emit = np.full((len(batch), wide, n), 1.0 / n)
            emit[live] = floor[place]
            steps = np.exp(log_steps)
            fwd, bwd = passes(emit, kind, steps)
            post = fwd * bwd
            post /= post.sum(2, keepdims=True)
            error = post[live]
            error[np.arange(len(place)), label[live]] -= 1
            by_word = np.stack([np.bincount(place, weights=error[:, y], minlength=len(used)) for y in range(n)], 1)
            h = by_word * (1 - FLOOR) * p / floor
            uses = np.bincount(place, minlength=len(used))[:, None]
            d = (h - p * h.sum(1, keepdims=True)) * ((1 + np.log1p(uses)) / uses)  # common words do not drown the others
            _descend(model.weights, grad2, grid[used], mask[used], d.astype(np.float32), 0.1)
            after, ok = bwd[:, 1:] * emit[:, 1:], live[:, 1:]
            for k in (0, 1):
                at = ok & (kind[:, 1:] == k)
                a, b = fwd[:, :-1][at], after[at]
                joint = a[:, :, None] * steps[k][None] * b[:, None, :]
                joint /= joint.sum((1, 2), keepdims=True)
                g = joint.sum(0)
                np.subtract.at(g, (label[:, :-1][at], label[:, 1:][at]), 1)
                step2[k] += g * g
                log_steps[k] -= 0.05 * g / np.sqrt(step2[k])
    steps = np.exp(log_steps)
    model.steps = steps / steps.sum(2, keepdims=True)
    model.rows = None


def train(documents: DataFrame) -> Model:
    """Fit on a bounded sample of ``documents`` (text, lang) with a label, picked by the
    hash of the text, so it does not depend on order."""
    low, high = SAMPLE_CHARS
    known = documents.filter(F.col("lang").isNotNull() & F.length("text").between(low, high))
    return fit([(r.text, r.lang) for r in bounded(known, "text", SAMPLE_DOCUMENTS, "lang", "text")])


def segments(text: str, words: list[tuple], post) -> list[tuple[int, int, str, float, int]]:
    """(start, end, language, confidence, letters) of maximal runs of one language."""
    import numpy as np

    if not words:
        return []
    label = post.argmax(1)
    runs: list[list[int]] = []  # [first, last, language]
    for k, y in enumerate(label):
        if runs and runs[-1][2] == y:
            runs[-1][1] = k
        else:
            runs.append([k, k, int(y)])
    out = []
    for a, b, y in runs:
        letters = sum(map(len, {words[k][2] for k in range(a, b + 1)}))  # stutters count once
        out.append([words[a][0], words[b][1], LANGUAGES[y], float(np.mean(post[a : b + 1, y])), letters])
    return [tuple(x) for x in out]


#: A language belongs to a text if a run of it holds so many letters, weighted by script.
RUN_LETTERS, RUN_LETTERS_DENSE = 8, 4
RUN_CONFIDENCE, SHORT_CONFIDENCE = 0.75, 0.95


def text_languages(found: list[tuple]) -> list[tuple[str, float]]:
    """Languages of a text with their confidence, from its segments."""
    if not found:
        return []
    weight: dict[str, float] = {}
    mass: dict[str, float] = {}
    strong = set()
    for _, _, lang, conf, letters in found:
        weight[lang] = weight.get(lang, 0) + letters
        mass[lang] = mass.get(lang, 0) + conf * letters
        need = RUN_LETTERS_DENSE if lang in ("zh", "ja", "ko", "th") else RUN_LETTERS
        if letters >= need and conf >= (RUN_CONFIDENCE if letters >= 2 * need else SHORT_CONFIDENCE):
            strong.add(lang)
    main = max(weight, key=lambda x: weight[x])
    return [(x, mass[x] / weight[x]) for x in sorted(strong | {main})]


def label_batch(model: Model, texts: list[str], folded=frozenset()) -> list[list[tuple]]:
    """Segments of every text of a batch; those in ``folded`` are in one form already."""
    clean = [t if t in folded else one_form(t) if t else "" for t in texts]
    words = [units(t) for t in clean]
    post = model.marginals(words)
    return [segments(t, w, p) for t, w, p in zip(clean, words, post)]


def _broadcast(df: DataFrame, model: Model):
    return df.sparkSession.sparkContext.broadcast(model)


def label(df: DataFrame, model: Model) -> DataFrame:
    """(payload_id, seg_no, lang, confidence, start_off, end_off): the segments."""
    shared = _broadcast(df, model)

    def kernel(columns: dict) -> dict:
        out = {n: [] for n in ("payload_id", "seg_no", "lang", "confidence", "start_off", "end_off")}
        for i, found in zip(columns["payload_id"], label_batch(shared.value, columns["source_text"])):
            for k, (a, b, lang, conf, _) in enumerate(found):
                for n, v in zip(out, (i, k + 1, lang, conf, a, b)):
                    out[n].append(v)
        return out

    rows = df.select("payload_id", "source_text").filter("source_text IS NOT NULL")
    return map_columns(rows, kernel, "payload_id bigint, seg_no int, lang string, confidence double, start_off int, end_off int")


def mislabelled(df: DataFrame, model: Model) -> DataFrame:
    """(payload_id, lang, confidence): each language of texts that are mixed or
    whose locale is missing, meaningless or names another language."""
    shared = _broadcast(df, model)

    def kernel(columns: dict) -> dict:
        out = {"payload_id": [], "lang": [], "confidence": []}
        keep = [k for k, t in enumerate(columns["source_text"]) if t and sum(map(str.isalpha, t)) >= MIN_LETTERS]
        texts = [columns["source_text"][k] for k in keep]
        for k, found in zip(keep, label_batch(shared.value, texts)):
            langs = text_languages(found)
            if len(langs) > 1 or langs and locale_language(columns["locale"][k]) != langs[0][0]:
                for lang, conf in langs:
                    out["payload_id"].append(columns["payload_id"][k])
                    out["lang"].append(lang)
                    out["confidence"].append(conf)
        return out

    return map_columns(
        df.select("payload_id", "source_text", "locale"), kernel, "payload_id bigint, lang string, confidence double"
    )
