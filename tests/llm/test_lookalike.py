import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st

from lectern.llm import lookalike as K

FAMILY = "👨‍👩‍👧 ❤️"


def test_fold():
    cases = {
        "ＡＢ１": ("AB1", True), "ｱｲ": ("アイ", True), "ｶﾞ": ("ガ", True), "éte": ("éte", True), "a​b": ("ab", True), "a b": ("a b", True),
        "vrai ?": ("vrai ?", False), "，！？": ("，！？", False), FAMILY: (FAMILY, False), "“x” – «y»": ("“x” – «y»", False), "naive": ("naive", False),
        "": ("", False), "क्‍ष": ("क्‍ष", False),
    }
    assert {k: K.fold_characters(k) for k in cases} == cases


def test_tokens():
    assert K.one_form("tһе end") == "the end"
    assert K.one_form("нaм нyжнo ещё") == "нам нужно ещё"
    assert K.one_form("Илона сказала hello") == "Илона сказала hello"
    assert K.one_form("Спикер B: да SpkA : файл v2.1 KE8952") == "Спикер B: да SpkA : файл v2.1 KE8952"


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="abcdeо еаАBСｅ́​ ?！ｱﾞ漢", max_size=30))
def test_fold_is_stable(text):
    once, _ = K.fold_characters(text)
    assert K.fold_characters(once) == (once, False)
    assert unicodedata.is_normalized("NFC", once)


def test_frame(spark):
    rows = [
        (1, "tһе cat", "the cat", "x"), (2, "the cat sat", "the cat sat", "x"), (3, None, "", None), (4, " ", None, ""), (5, "a" * 200_000 + "ｂ", "ok", "y"),
        (6, "tһе cat", "the cat", "x"), (None, "ａ", None, None),
    ]
    df = spark.createDataFrame(rows, "payload_id bigint, source_text string, corrected_text string, text string").withColumnRenamed("text", "known")
    assert {tuple(r) for r in K.found(df).collect()} == {(1, "source_text"), (5, "source_text"), (6, "source_text"), (None, "source_text")}
    clean = {(r.payload_id, r.field): r.clean_text for r in K.clean(df).collect()}
    assert clean[1, "source_text"] == "the cat" and clean[5, "source_text"].endswith("ab") and clean[4, "source_text"] == " " and (3, "source_text") not in clean
    assert K.found(df.limit(0)).count() == 0 and K.clean(df.limit(0)).count() == 0


def test_every_substitution_asks_the_vocabulary(spark):
    """A mixed token whose repaired form stands nowhere is no case and stays; one whose
    first form is unknown takes the next; rows under one id are judged one by one."""
    rows = [(1, "zоrgle one", None), (2, "the cаt", "a cat"), (2, "the cаt", "a cat"), (3, "\u043c\u0061\u043c\u0430 и наш мир", "\u043c\u0430\u043c\u0430")]
    df = spark.createDataFrame(rows, "payload_id bigint, source_text string, corrected_text string")
    assert sorted((r.payload_id, r.field) for r in K.found(df).collect()) == [(2, "source_text"), (3, "source_text")]
    got = sorted((r.payload_id, r.clean_text, r.changed) for r in K.clean(df).filter("field = 'source_text'").collect())
    assert got == [(1, "zоrgle one", False), (2, "the cat", True), (2, "the cat", True), (3, "\u043c\u0430\u043c\u0430 и наш мир", True)]


def test_known_words_by_either_way(spark, monkeypatch):
    texts = K.long_form(spark.createDataFrame([(k, "Hot hot word %d" % (k % 5), "x") for k in range(90)], "payload_id bigint, source_text string, corrected_text string"))
    words = spark.createDataFrame([("hot",), ("x",), ("none",)], "word string")
    sent = sorted(r.word for r in K.known_words(texts, words).collect())
    monkeypatch.setattr(K, "SENT_WORDS", 1)
    assert sent == sorted(r.word for r in K.known_words(texts, words).collect()) == ["hot", "x"]


def test_long_tokens_ask_the_vocabulary_too(spark, monkeypatch):
    """A token of any length is repaired if its form is known, whichever way it is looked
    up; one whose form is unknown stays."""
    rows = []
    for k, length in enumerate((40, 41, 60, 5000)):
        word = "sweet" + "abcdefghij"[k] * (length - 5)
        rows += [(k, word.replace("e", "\u0435") + " tooth", word), (10 + k, "un" + word.replace("e", "\u0435"), None)]
    df = spark.createDataFrame(rows, "payload_id bigint, source_text string, corrected_text string")
    want = sorted((i, t if i > 9 else w + " tooth", i < 10) for i, t, w in rows)
    for most in (K.SENT_WORDS, 1):
        monkeypatch.setattr(K, "SENT_WORDS", most)
        assert sorted(tuple(r) for r in K.found(df).collect()) == [(k, "source_text") for k in range(4)]
        got = K.clean(df).filter("field = 'source_text'").select("payload_id", "clean_text", "changed")
        assert sorted(tuple(r) for r in got.collect()) == want
