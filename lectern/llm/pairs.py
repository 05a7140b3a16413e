"""Broken prompt and response pairs.

A payload's ``source_text`` is the request, ``corrected_text`` (same language) and
``translation`` (English) are its answers. Each answer gets at most one defect, in
this order: empty, refusal, copy, wrong_language, truncated.

* refusals by a grammar of negated ability, task verb and task noun per language,
  unless the answer is covered by the source or the source declines something;
* copies and left-out content by greedy string tiling of folded tokens;
* common tokens bound the tiling from above and only spare it where they are few;
* an answer in the source's language that is not made of it is truncated if it is
  shorter than what it must cover or left open, else it has no defect;
* truncation also by a pushdown parser for quotes, brackets, fences, lists and
  markup left open at the end, and by the length an answer has over all rows of its
  language;
* languages by the language model, asked only where tiling leaves a doubt.

Defined results
---------------
* rows whose source holds no speech are no cases; null and blank answers are
  ``empty``; a corrected text that covers its source has no defect;
* repeated rows are judged one by one; extra columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata as ud
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm import langid
from lectern.llm.lookalike import one_form
from lectern.llm.sentences import Chain, sentence_ends
from lectern.llm.turns import LABEL, is_label, bare
from lectern.operators.arrow import map_columns

# Placeholders for nothing, compared without case, quotes and brackets.
NOTHING = ("none", "null", "nil", "n/a", "na", "nan", "empty", "undefined", "blank", "notext", "nothing", "tbd", "todo", "missing")
_NOTHING = set(NOTHING)

_NEG = (
    r"(?:can(?:no|['’])?t|cannot|could not|unable to|not able to|(?:will not|won['’]?t)(?: be able to)?|(?:have|need|must|going)(?: to)? decline(?: to)?|decline to|"
    r"(?:isn['’]?t|is not|not) possible(?: for me)?(?: to)?|not (?:allowed|permitted) to|may not|refuse to)"
)
_VERB = (
    r"(?:process|translate|correct|edit|complete|continue|work|provide|produce|assist|help|comply|handle|fulfil|fulfill|respond|"
    r"perform|generate|proceed|transcribe|refine|clean|rewrite|answer|do)"
)
_NOUN = (
    r"(?:request|segment|transcript|transcription|content|material|text|input|recording|correction|translation|result|task|"
    r"passage|document|output|prompt|answer|that[.!]|this[.!]|this one|that one)"
)
# Grammars of a declined task, one per language.
REFUSALS = {
    "en": rf"\b{_NEG}\b[^.!?\n]{{0,20}}?\b{_VERB}\b(?! you\b)[^.!?\n]{{0,60}}?\b{_NOUN}|\b{_NOUN} (?:cannot|can['’]?t|could not|may not) be \w+|\bas an? (?:ai|language model|assistant)\b",
    "de": r"\b(?:kann|darf|konnte|möchte)\b.{0,40}\b(?:anfrage|text|inhalt|segment|eingabe|aufgabe|transkript)\w*\b.{0,30}\bnicht\b|\bnicht\b.{0,30}\b(?:anfrage|text|inhalt|segment|eingabe|aufgabe|transkript)\w*\b.{0,30}(?:bearbeiten|korrigieren|übersetzen|verarbeiten|helfen)"
    r"|\b(?:anfrage|text|inhalt|segment|eingabe|aufgabe|transkript)\w*\b.{0,30}\b(?:kann|darf|konnte|könnte)\b.{0,30}\bnicht (?:bearbeiten|bearbeitet|korrigieren|übersetzen|verarbeiten|verarbeitet|erfüllen)",
    "fr": r"(?:ne (?:peux|puis|pouvons) pas|pas en mesure|impossible)\b.{0,30}\b(?:traiter|corriger|traduire|aider|répondre|continuer)\b.{0,40}\b(?:demande|texte|contenu|requête|segment|transcription)",
    "es": r"\bno (?:puedo|podemos|es posible|me es posible)\b.{0,30}\b(?:ayudar|procesar|corregir|traducir|completar|continuar)\b.{0,40}\b(?:solicitud|texto|contenido|petición|segmento|transcripción)",
    "pl": r"\bnie (?:mogę|możemy|jestem w stanie)\b.{0,30}\b(?:przetworzyć|poprawić|przetłumaczyć|pomóc|wykonać|edytować)\b.{0,40}\b(?:tekst|prośb|żądan|treś|zapytan|segment)",
    "cs": r"(?:požadav|text|obsah|žádost|segment)\w*.{0,30}\b(?:nemohu|nemůžu|nelze|nejsem schopen)\b.{0,30}(?:zpracovat|opravit|přeložit|pomoci|splnit|upravit)|\b(?:nemohu|nemůžu|nelze)\b.{0,30}(?:zpracovat|opravit|přeložit|splnit|upravit)\b.{0,40}(?:požadav|text|obsah|žádost|segment)",
    "id": r"\btidak (?:dapat|bisa|mampu)\b.{0,20}\b(?:memproses|mengoreksi|menerjemahkan|membantu|melanjutkan|memenuhi)\b.{0,40}\b(?:permintaan|teks|konten|segmen|transkrip)",
    "ru": r"(?:не могу|не могла?|невозможно|не в состоянии).{0,30}(?:обработать|исправить|перевести|помочь|выполнить|продолжить).{0,40}(?:запрос|текст|содерж|задани|сегмент)",
    "ar": r"(?:لا يمكنني|لا أستطيع|لا يمكن|أعتذر).{0,30}(?:معالجة|تصحيح|ترجمة|المساعدة|تنفيذ|إكمال).{0,40}(?:الطلب|النص|المحتوى|المقطع)",
    "hi": r"(?:अनुरोध|पाठ|सामग्री|टेक्स्ट|लेख).{0,40}(?:नहीं (?:कर|किया|दे)|असमर्थ)",
    "zh": r"(?:无法|不能|没法|未能).{0,8}(?:处理|更正|翻译|完成|协助|修改|继续|满足).{0,12}(?:请求|文本|内容|要求|片段|任务)",
    "ja": r"(?:リクエスト|ご依頼|依頼|内容|テキスト|文章|要求).{0,12}(?:対応|処理|翻訳|修正|お手伝い)?.{0,6}(?:できません|できかねます|いたしかねます)",
    "ko": r"(?:요청|텍스트|내용|문장|콘텐츠).{0,14}(?:할 수 없|드릴 수 없|불가능|못 합)",
    "th": r"ไม่(?:สามารถ|อาจ).{0,24}(?:ดำเนินการ|แปล|แก้ไข|ช่วย|ประมวลผล).{0,24}(?:คำขอ|ข้อความ|เนื้อหา)",
}
# Stems of the task nouns, one of which every refusal of a language holds.
REFUSAL_STEMS = {
    "en": ("request", "segment", "transcript", "content", "material", "text", "input", "recording", "correction", "translation", "result", "task", "passage",
           "document", "output", "prompt", "answer", "that.", "that!", "this.", "this!", "this one", "that one", "as a ai", "as an ai", "language model", "assistant"),
    "de": ("anfrage", "text", "inhalt", "segment", "eingabe", "aufgabe", "transkript"),
    "fr": ("demande", "texte", "contenu", "requête", "segment", "transcription"),
    "es": ("solicitud", "texto", "contenido", "petición", "segmento", "transcripción"),
    "pl": ("tekst", "prośb", "żądan", "treś", "zapytan", "segment"),
    "cs": ("požadav", "text", "obsah", "žádost", "segment"),
    "id": ("permintaan", "teks", "konten", "segmen", "transkrip"),
    "ru": ("запрос", "текст", "содерж", "задани", "сегмент"),
    "ar": ("الطلب", "النص", "المحتوى", "المقطع"),
    "hi": ("अनुरोध", "पाठ", "सामग्री", "टेक्स्ट", "लेख"),
    "zh": ("请求", "文本", "内容", "要求", "片段", "任务"),
    "ja": ("リクエスト", "依頼", "内容", "テキスト", "文章", "要求"),
    "ko": ("요청", "텍스트", "내용", "문장", "콘텐츠"),
    "th": ("คำขอ", "ข้อความ", "เนื้อหา"),
}
_REFUSAL = {k: re.compile(p, re.IGNORECASE) for k, p in REFUSALS.items()}

_TOKEN = re.compile(r"[a-zɐ-ʯ'ªº]+|[À-ɏ]+|[Ѐ-ԯ]+|[؀-ۿ]+|[ऀ-ॿ]+|[가-힯ᄀ-ᇿ]+|\d+|[㐀-鿿぀-ヿ฀-๿]|[^\W\d_]+")

_PREFIX = re.compile(r"^\W*[A-Za-z]{3,14}\s?[:：]\s*")
# English words that none of the other languages writes.
_ENGLISH = set("the and that this you with have what why does where please told there".split())
_CLOSED = re.compile(r"[.!?…。！？।؟¿]+[\"'”’»)\]」』）*_]*\s*$")


_ACCENTED = re.compile("[\u00c0-\u024f\u0300-\u036f\u1e00-\u1eff]")
_ACCENT = re.compile("[\u0300-\u036f]+")
_STROKE = str.maketrans("łøđħŧ", "lodht")  # letters whose stroke is no accent


def fold(text: str) -> str:
    """Lower case; Latin letters without accents."""
    low = text.lower()
    return _ACCENT.sub("", ud.normalize("NFD", low)).translate(_STROKE) if _ACCENTED.search(low) else low


def speech(text: str) -> str:
    """What was said: no labels, time stamps, sounds and fillers."""
    text = one_form(text)
    if ":" in text or "：" in text or "<" in text:
        at, out = 0, []
        for m in LABEL.finditer(text):
            if is_label(m, text):
                out.append(text[at : m.start()])
                at = m.end()
        text = " ".join(out + [text[at:]]) if out else text
    return bare(text)


_ANSWER_LABEL = re.compile(r"\[[^\[\]\n]{1,40}\]\s?[:：]")


def tokens(text: str) -> list[str]:
    """Folded tokens, stutters once; single characters where words have no spaces."""
    out: list[str] = []
    for t in _TOKEN.findall(fold(text)):
        if not out or out[-1] != t:
            out.append(t)
    return out


def common(a: list[str], b: list[str]) -> float:
    """Upper bound of the share of ``a`` that tiles can cover from ``b``."""
    return sum((Counter(a) & Counter(b)).values()) / len(a) if a else 1.0


#: Tokens of either side that a tile may pass over.
_BRIDGES = ((0, 0), (1, 1), (0, 1), (1, 0), (0, 2), (0, 3))


def tiling(a: list[str], b: list[str], least: int = 2, bridge: bool = False) -> float:
    """Share of ``a`` covered by greedy string tiling with ``b``: the longest common
    runs first, no token used twice, runs of at least ``least`` tokens. With
    ``bridge`` a tile goes on behind one corrected token or up to three put in."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    least = min(least, len(a), len(b))
    places: dict[tuple, list[int]] = {}
    for j in range(len(b) - least + 1):
        places.setdefault(tuple(b[j : j + least]), []).append(j)
    used_a, used_b = [False] * len(a), [False] * len(b)
    covered = 0
    tiles: list[tuple[int, int, int]] = []
    runs: list[tuple[int, int, int]] = []
    for i in range(len(a) - least + 1):
        for j in places.get(tuple(a[i : i + least]), ()):
            if i and j and a[i - 1] == b[j - 1]:
                continue  # part of a longer run
            n = least
            while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                n += 1
            runs.append((n, i, j))
    for n, i, j in sorted(runs, key=lambda r: (-r[0], r[1], r[2])):
        k = 0
        while k < n:  # what earlier tiles left of this run
            while k < n and (used_a[i + k] or used_b[j + k]):
                k += 1
            m = k
            while m < n and not (used_a[i + m] or used_b[j + m]):
                m += 1
            if m - k >= least:
                covered += m - k
                tiles.append((m - k, i + k, j + k))
                used_a[i + k : i + m] = [True] * (m - k)
                used_b[j + k : j + m] = [True] * (m - k)
            k = m
    for n, i, j in tiles if bridge else ():
        for step, x, y in ((1, i + n, j + n), (-1, i - 1, j - 1)):
            while True:
                for da, db in _BRIDGES:
                    u, v = x + da * step, y + db * step
                    if 0 <= u < len(a) and 0 <= v < len(b) and a[u] == b[v] and not used_a[u] and not any(used_b[min(y, v) : max(y, v) + 1]):
                        break
                else:
                    break
                used_a[u] = used_b[v] = True
                covered, x, y = covered + 1, u + step, v + step
    return covered / len(a)


def tiled(a: list[str], b: list[str], least: float) -> float:
    """The tiling of ``a`` with ``b``, or its upper bound where that is below ``least``."""
    if a == b:
        return 1.0
    bound = common(a, b)
    return bound if bound < least else tiling(a, b, bridge=True)


_PAIR = {")": "(", "]": "[", "}": "{", "）": "（", "」": "「", "』": "『", "»": "«", "”": "“", ">": "<"}
_OPEN = re.compile(r"```|[()\[\]{}（）「」『』«»“”„\"]|</?[a-zA-Z]+>")


def left_open(text: str) -> bool:
    """Pushdown parser: True if a quotation, bracket, fence, list or mark-up element is
    open at the end."""
    stack: list[str] = []
    for m in _OPEN.finditer(text):
        t = m[0]
        if t in ('"', "```"):
            if stack and stack[-1] == t:
                stack.pop()
            elif t in stack:
                del stack[stack.index(t) :]
            else:
                stack.append(t)
        elif t[0] == "<" and len(t) > 2:
            if t[1] != "/":
                stack.append(t.lower())
            elif stack and stack[-1] == "<" + t[2:].lower():
                stack.pop()
        elif t == "“" and "„" in stack:
            del stack[len(stack) - 1 - stack[::-1].index("„") :]
        elif t in _PAIR:
            want = _PAIR[t]
            if t == "”" and "„" in stack:
                want = "„"
            if want in stack:
                del stack[len(stack) - 1 - stack[::-1].index(want) :]
        else:
            stack.append(t)
    return bool(stack) or bool(re.search(r"(?:^|\n)\s*(?:[-*•]|\d+[.)])\s*$", text))


#: More letters and digits than any placeholder has.
_SAYS_SOMETHING = re.compile(rf"(?:[\W_]*[^\W_]){{{max(map(len, NOTHING)) + 1}}}")


def is_empty(text: str | None) -> bool:
    if text is None or not text.strip():
        return True
    if _SAYS_SOMETHING.match(text):
        return False
    core = re.sub(r"[^\w/]", "", text.lower())
    return core.strip("_/") == "" or core in _NOTHING


def is_refusal(text: str) -> bool:
    """True if a task is declined anywhere in a text, however long. The grammar of a
    language is tried where one of its nouns stands."""
    low = text.lower()
    return any(_REFUSAL[k].search(text) for k, stems in REFUSAL_STEMS.items() if any(x in low for x in stems))


_WORD = re.compile(r"[^\W_]+")


def _plain(text: str) -> int:
    return len("".join(text.split()))


def _english(text: str) -> bool:
    words = _WORD.findall(ud.normalize("NFC", text).lower())  # with accents: French "thé" is not "the"
    hits = [w for w in words if w in _ENGLISH]
    return len(set(hits)) >= 2 and len(hits) >= 0.12 * len(words)


#: Shares of the source that a whole answer covers or reaches in length.
LEFT_OUT = 0.70
OPEN_LENGTH, CLOSED_LENGTH, SHORT_LENGTH = 0.80, 0.85, 0.60


class Judge:
    """Language model, sentence chain and the usual length of a translation per
    character of text, by language."""

    def __init__(self, languages: langid.Model, chain: Chain, ratio: dict[str, float]):
        self.languages, self.chain, self.ratio = languages, chain, ratio

    def batch(self, sources: list, corrected: list, translations: list) -> list[list[tuple[str, str]]]:
        out: list[list[tuple[str, str]]] = [[] for _ in sources]
        ask: dict[str, None] = {}
        work = []
        for k, (s, c, t) in enumerate(zip(sources, corrected, translations)):
            said = speech(s) if s else ""
            src = tokens(said)
            if not any(w[0].isalpha() for w in src):
                continue
            item = {"k": k, "said": said, "src": src, "s": s, "c": c, "t": t}
            if is_empty(c):
                out[k].append(("corrected_text", "empty"))
                item["c_bad"] = True
            else:
                said_c = _ANSWER_LABEL.sub(" ", one_form(c))
                item["ctok"] = ctok = tokens(said_c)
                cover = tiled(src, ctok, LEFT_OUT)
                if cover < LEFT_OUT:
                    if tiled(ctok, src, 0.5) < 0.5:
                        if is_refusal(c):
                            out[k].append(("corrected_text", "refusal"))
                            item["c_bad"] = True
                        else:
                            ask[said] = ask[said_c] = None
                            item["c_ask"] = said_c
                    else:
                        out[k].append(("corrected_text", "truncated"))
                        item["c_bad"] = True
                elif cover < CLOSED_LENGTH and left_open(c) and not left_open(s):
                    out[k].append(("corrected_text", "truncated"))
                    item["c_bad"] = True
            if is_empty(t):
                out[k].append(("translation", "empty"))
            else:
                item["ttok"] = ttok = tokens(_PREFIX.sub("", t, count=1))
                mine = tiled(ttok, src, 0.5)
                if mine < 0.8 and "c_bad" not in item and "c_ask" not in item:
                    mine = max(mine, tiled(ttok, item["ctok"], 0.5))
                item["mine"] = mine
                if is_refusal(t) and mine < 0.5 and not is_refusal(said):
                    out[k].append(("translation", "refusal"))
                else:
                    item["t_open"] = True
                    if mine >= 0.8 or not _english(t):
                        ask[said] = ask[t] = None
                        item["t_ask"] = True
            work.append(item)
        langs: dict[str, dict[str, float]] = {}
        texts = list(ask)
        for text, found in zip(texts, langid.label_batch(self.languages, texts, {item["said"] for item in work})):
            weight: dict[str, float] = {}
            for _, _, lang, conf, letters in found:
                weight[lang] = weight.get(lang, 0.0) + conf * letters
            whole = sum(weight.values()) or 1.0
            langs[text] = {x: v / whole for x, v in weight.items()}
        main = lambda text: max(langs[text], key=langs[text].get) if langs.get(text) else None
        for item in work:
            k = item["k"]
            if "c_ask" in item:
                own, theirs = langs[item["said"]], langs[item["c_ask"]]
                answer = main(item["c_ask"])
                if answer and own and own.get(answer, 0.0) < 0.15 and theirs[answer] > 0.6:
                    out[k].append(("corrected_text", "wrong_language"))
                elif len(item["ctok"]) < LEFT_OUT * len(item["src"]) or (left_open(item["c"]) and not left_open(item["s"])):
                    out[k].append(("corrected_text", "truncated"))
                item["c_bad"] = True
            if "t_open" not in item:
                continue
            t = item["t"]
            if "t_ask" in item:
                own, answer = langs[item["said"]], main(t)
                source = main(item["said"])
                if answer and answer != "en" and langs[t][answer] > 0.6:
                    if own.get(answer, 0.0) < 0.15:
                        out[k].append(("translation", "wrong_language"))
                        continue
                    if item["mine"] >= 0.7:
                        out[k].append(("translation", "copy"))
                        continue
                elif item["mine"] >= 0.9 and source and source != "en" and own.get("en", 0.0) < 0.3:
                    out[k].append(("translation", "copy"))
                    continue
            if self._cut_short(item, langs, main):
                out[k].append(("translation", "truncated"))
        return out

    def _cut_short(self, item: dict, langs: dict, main) -> bool:
        t = item["t"]
        whole = item["c"] if "c_bad" not in item else item["said"]
        share = _plain(t) / max(1.0, expected_length(whole, self.ratio))
        if share >= CLOSED_LENGTH:
            return False
        if not _CLOSED.search(t) or left_open(t):
            return share < OPEN_LENGTH
        if "c_bad" in item:
            return share < 0.66
        if share < SHORT_LENGTH and _CLOSED.search(t)[0].startswith(("...", "…")):
            return True
        there, here = len(sentence_ends(whole, self.chain)), len(sentence_ends(t, self.chain))
        return here <= LEFT_OUT * there or (share < 0.5 and here < there)


_SCRIPTS = (("th", "[ก-๎]"), ("ja", "[ぁ-ヿ]"), ("ko", "[가-힯]"), ("zh", "[一-鿿]"), ("hi", "[ऀ-ॿ]"), ("ar", "[؀-ۿ]"), ("ru", "[Ѐ-ӿ]"))
_LATIN_LETTER = re.compile("[A-Za-z\u00c0-\u024f]")
_SCRIPT_RE = [(k, re.compile(p)) for k, p in _SCRIPTS]


def expected_length(text: str, ratio: dict[str, float]) -> float:
    """Usual length of a whole translation: the mean of the scripts' ratios over the
    letters, times the characters."""
    size, latin = float(_plain(text)), ratio.get("latin", 1.0)
    if text.isascii():
        return size * latin
    letters = float(len(_LATIN_LETTER.findall(text)))
    total, japanese = letters * latin, False
    for key, p in _SCRIPT_RE:
        n = len(p.findall(text))
        japanese |= key == "ja" and n > 0
        total += n * ratio.get("ja" if japanese and key == "zh" else key, latin)
        letters += n
    return size * (total / letters if letters else latin)


def usual_lengths(df: DataFrame) -> dict[str, float]:
    """Median characters of a translation per character of corrected text, over all
    rows, by the script of the corrected text (eight groups)."""
    text = F.col("corrected_text")
    group = F.lit("latin")
    for key, p in reversed(_SCRIPTS):
        group = F.when(text.rlike(f"{p}[^a-zA-Z]{{0,3}}{p}"), key).otherwise(group)
    size = lambda c: F.length(F.regexp_replace(c, r"\s", ""))
    rows = df.filter("length(corrected_text) > 20 AND length(translation) > 20")
    got = rows.groupBy(group.alias("g")).agg(F.percentile_approx(size("translation") / size("corrected_text"), 0.5, 1000).alias("m"))
    return {r.g: r.m for r in got.collect()}


def defects(df: DataFrame, judge: Judge) -> DataFrame:
    """(payload_id, field, defect) of every defective answer."""
    shared = df.sparkSession.sparkContext.broadcast(judge)

    def kernel(columns: dict) -> dict:
        out = {"payload_id": [], "field": [], "defect": []}
        found = shared.value.batch(columns["source_text"], columns["corrected_text"], columns["translation"])
        for i, rows in zip(columns["payload_id"], found):
            for field, defect in rows:
                out["payload_id"].append(i)
                out["field"].append(field)
                out["defect"].append(defect)
        return out

    rows = df.select("payload_id", "source_text", "corrected_text", "translation")
    return map_columns(rows, kernel, "payload_id bigint, field string, defect string")
