import itertools
import random

import pytest

from lectern.llm import langid, pairs as K
from lectern.llm.sentences import Chain


def test_tiling_by_brute_force():
    """Covered tokens equal an independent greedy tiling."""

    def slow(a, b):
        used_a, used_b, covered = set(), set(), 0
        while True:
            best = (0, 0, 0)
            for i, j in itertools.product(range(len(a)), range(len(b))):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and i + n not in used_a and j + n not in used_b:
                    n += 1
                best = max(best, (n, -i, -j))
            if best[0] < 2:
                return covered
            covered += best[0]
            used_a |= set(range(-best[1], -best[1] + best[0]))
            used_b |= set(range(-best[2], -best[2] + best[0]))

    rng = random.Random(2)
    for _ in range(150):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(1, 9))] for _ in range(2))
        assert abs(K.tiling(a, b) * len(a) - slow(a, b)) <= 2  # runs of one length may be cut differently


def test_open_at_end():
    assert K.left_open('He said "yes') and K.left_open("a (b") and K.left_open("```x") and K.left_open("one\n- ") and K.left_open("<b>x")
    assert not K.left_open('He said "yes".') and not K.left_open("„Ano,“ řekl") and not K.left_open("(a [b]) {c}") and not K.left_open("<b>x</b>")


def test_refusals_and_empty():
    assert K.is_refusal("I'm sorry, but I can't assist with that request.") and K.is_refusal("抱歉，我无法处理该请求。") and K.is_refusal("This content cannot be processed.")
    assert not K.is_refusal("I am sorry but I cannot help you with that today.") and not K.is_refusal("We worked on the report for 4 years.")
    assert all(map(K.is_empty, (None, "", " \n", "N/A", "[no text]", "…", "{}", '""', "(empty)", "???"))) and not K.is_empty("No.") and not K.is_empty("好")


@pytest.fixture(scope="module")
def judge():
    import pyarrow.parquet as pq

    docs = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text", "lang"]).to_pylist()
    lang = langid.fit([(d["text"], d["lang"]) for d in docs if d["lang"] and d["text"] and 40 <= len(d["text"]) <= 4000][:500])
    return K.Judge(lang, Chain(), {"latin": 1.0})


SOURCE = "ten lístek přestal fungovat a všechno najdete v knihovně po schůzce v pátek ráno"
ENGLISH = "The ticket stopped working and you will find everything at the library after the meeting on Friday morning."
CASES = [
    (SOURCE, SOURCE + ".", ENGLISH, []),
    (SOURCE, None, ENGLISH, [("corrected_text", "empty")]),
    (SOURCE, "Ten lístek přestal", ENGLISH, [("corrected_text", "truncated")]),
    (SOURCE, "I cannot process this transcript.", ENGLISH, [("corrected_text", "refusal")]),
    (SOURCE, ENGLISH, ENGLISH, [("corrected_text", "wrong_language")]),
    (SOURCE, SOURCE, "Translation: " + SOURCE, [("translation", "copy")]),
    (SOURCE, SOURCE, "The ticket stop", [("translation", "truncated")]),
    ("[noise] 👍", "", "", []),
    (None, None, None, []),
]


def test_defects(judge):
    got = judge.batch(*map(list, zip(*[c[:3] for c in CASES])))
    assert got == [c[3] for c in CASES]


def test_frame(spark, judge):
    rows = [(k, *c[:3], 1) for k, c in enumerate(CASES)] + [(99, "word " * 40_000, "word " * 40_000, "word " * 40_000, 1), (1, *CASES[1][:3], 1)]
    df = spark.createDataFrame(rows, "payload_id bigint, source_text string, corrected_text string, translation string, field int")
    got = [tuple(r) for r in K.defects(df, judge).collect()]
    assert got.count((1, "corrected_text", "empty")) == 2 and (5, "translation", "copy") in got
    assert K.defects(df.limit(0), judge).count() == 0 and isinstance(K.usual_lengths(df.limit(0)), dict)


WORDS = "please send the parcel to marta before friday and tell her where she put the recipe for the meeting".split()


@pytest.mark.parametrize(
    "source, corrected, defect",
    [
        (" ".join(WORDS), " ".join(WORDS[:11] + WORDS[:10:-1]), "truncated"),  # all words, but runs of the first eleven only
        ("อืมก่อนอื่นเราต้องตรวจตั๋วครับ เราทำพัสดุมา518ปีแล้วคุ้มค่ามากครับ เราทำพัสดุมา14ปีแล้วคุ้มค่ามากครับ", "ขออภัยไม่สามารถดำเนินการตามคำขอนี้ได้", "refusal"),
        ("potrzebny jest kontrakt dwa kable i troche papieru na jutro rano w szkole", 'Potrz', "truncated"),
        (" ".join(WORDS), 'Please send the parcel to Marta before Friday and tell her "where she put the', "truncated"),
        ("sprzet kosztowal ok 4,23 zl przy al lipowej", "Sprzęt kosztował ok. 4,23 zł przy al. Lipowej.", None),
        ("Speaker A: one thing: Do you know where Jiří Pazo put the recipe?", "[SPKA]: Do you know where Jiří Pazo put the recipe?", None),
    ],
)
def test_tiling_decides(judge, source, corrected, defect):
    got = [d for f, d in judge.batch([source], [corrected], ["The translation does not matter here."])[0] if f == "corrected_text"]
    assert got == ([defect] if defect else [])


def test_copy_of_polish_is_no_english(judge):
    """Everyday Polish words that English writes too prove no English."""
    text = 'Oskar powiedział "to na pewno i tak do mnie należy, możemy iść" i wrócił do domu, on i ja idziemy do szkoły.'
    assert judge.batch([text], [text], [text]) == [[("translation", "copy")]]
    assert not K._english(text) and not K._english("Le thé, this") and K._english("Where is the parcel that you told them about?")


def test_stems_cover_the_grammars():
    """Whatever a grammar finds holds one of its stems: those of the answers that are
    refusals, and samples of every grammar."""
    said = [
        "I cannot process this transcript.", "As an AI language model I stop here.", "This content cannot be processed.", "I'm unable to help with that.",
        "Diese Anfrage kann ich leider nicht bearbeiten.", "Je ne peux pas traiter cette demande.", "No puedo procesar esta solicitud.", "Nie mogę przetworzyć tego tekstu, prośba odrzucona.",
        "Tento požadavek nemohu zpracovat.", "Saya tidak dapat memproses permintaan ini.", "Я не могу обработать этот запрос.", "لا يمكنني معالجة هذا الطلب",
        "मैं यह अनुरोध पूरा नहीं कर सकता", "抱歉，我无法处理该请求。", "このリクエストには対応できません。", "이 요청을 처리할 수 없습니다.", "ไม่สามารถดำเนินการตามคำขอนี้ได้",
    ]
    for text in said:
        assert K.is_refusal(text), text
        assert K.is_refusal("Word after word. " * 200 + text)
