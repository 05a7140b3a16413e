"""Queries of the training-data operators and their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import langid, lookalike, mixing, mojibake, packing, pairs, pieces, sentences, tokens, turns
from lectern.session import cut, prepare, spread
from lectern.sources.files import scratch
from lectern.sources.tables import table


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Texts that hold characters standing for others."""
    prepare(spark)
    return lookalike.found(spread(table(spark, folder, "payloads").select("payload_id", *lookalike.FIELDS)))


def p2_clean(spark: SparkSession, folder: str) -> DataFrame:
    """All texts in one form."""
    prepare(spark)
    return lookalike.clean(spread(table(spark, folder, "payloads").select("payload_id", *lookalike.FIELDS)))


def _long_texts(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "payloads").select("payload_id", "source_text", "seg_start", "seg_end")
    return spread(rows.filter(F.length("source_text") > pieces.LIMIT))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Payloads that come out in more than one piece."""
    prepare(spark)
    return pieces.pieces(_long_texts(spark, folder)).filter("piece_no = 2").select("payload_id")


def p3_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Ordered pieces of every oversized text."""
    prepare(spark)
    return pieces.pieces(_long_texts(spark, folder))


def p3_files(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of large files by byte range: the documents of every source, written as
    text to the shared folder. Ranges are small here so that files of tests have several."""
    prepare(spark)
    path = scratch(spark, "texts")
    docs = table(spark, folder, "documents").filter("text IS NOT NULL").select(F.coalesce("source", F.lit("none")).alias("source"), "text")
    docs.write.partitionBy("source").text(path)
    cut_ = pieces.split_files(spark, sorted(spark.read.text(path).inputFiles()), size=1 << 16)
    return cut_.withColumn("path", F.regexp_extract("path", r"source=.*", 0))


def _punctuated(spark: SparkSession, folder: str) -> DataFrame:
    """Fields whose punctuation is complete, of rows cut at sentence edges."""
    rows = table(spark, folder, "payloads").filter("seg_start = 'high' AND seg_end = 'high'")
    source = F.when((F.size("ct_punct.edits") == 0) & F.col("ct_punct").isNotNull(), F.col("source_text"))
    fields = F.array(
        F.struct(F.lit("corrected_text").alias("field"), F.col("corrected_text").alias("text")),
        F.struct(F.lit("source_text").alias("field"), source.alias("text")),
    )
    return spread(rows.select("payload_id", F.inline(fields)).filter("text IS NOT NULL"))


def _chain(spark: SparkSession, folder: str, bare: bool = False, most: int = sentences.SAMPLE_ROWS) -> sentences.Chain:
    return sentences.train(table(spark, folder, "payloads").select("corrected_text", "ct_punct"), bare, most)


#: Labelled rows of the chain by which sentences of answers are only counted.
COUNTING_ROWS = 5000


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Sentence ends of the punctuated fields."""
    prepare(spark)
    found = sentences.units(_punctuated(spark, folder), _chain(spark, folder))
    return found.select("payload_id", "field", "sent_end")


def p4_units(spark: SparkSession, folder: str) -> DataFrame:
    """Ordered sentence units of both fields of every payload."""
    prepare(spark)
    rows = spread(lookalike.long_form(table(spark, folder, "payloads").select("payload_id", *lookalike.FIELDS)))
    return sentences.units(rows, _chain(spark, folder, bare=True))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Speaker turns: every label starts one, so pauses split nothing here."""
    prepare(spark)
    rows = spread(table(spark, folder, "payloads").select("payload_id", "source_text"))
    return turns.speaker_turns(rows).select("payload_id", "turn_no", "speaker")


def p5_turns(spark: SparkSession, folder: str) -> DataFrame:
    """Turns with their clean speech, split at labels and at calibrated pauses."""
    prepare(spark)
    rows = spread(table(spark, folder, "payloads").select("payload_id", "source_text"))
    return turns.speaker_turns(rows, turns.calibrated_pause(rows))


def _languages(spark: SparkSession, folder: str) -> langid.Model:
    return langid.train(table(spark, folder, "documents").select("text", "lang"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """Defective answers with their defect."""
    prepare(spark)
    rows = table(spark, folder, "payloads").select("payload_id", "source_text", "corrected_text", "translation")
    judge = pairs.Judge(_languages(spark, folder), _chain(spark, folder, most=COUNTING_ROWS), pairs.usual_lengths(rows))
    return pairs.defects(spread(rows), judge)


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    """Languages of mixed texts and of texts whose locale is missing or wrong."""
    prepare(spark)
    rows = spread(table(spark, folder, "payloads").select("payload_id", "source_text", "locale"))
    return langid.mislabelled(rows, _languages(spark, folder)).select("payload_id", "lang")


def p7_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Language and confidence of every segment."""
    prepare(spark)
    rows = spread(table(spark, folder, "payloads").select("payload_id", "source_text"))
    return langid.label(rows, _languages(spark, folder))


def _counts(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts, tokenised once and cut from their lineage."""
    rows = spread(table(spark, folder, "documents").select("doc_id", "source", "text"))
    return cut(tokens.with_counts(rows))


def p8_packed(spark: SparkSession, folder: str) -> DataFrame:
    """Containers of every capacity."""
    prepare(spark)
    counts = _counts(spark, folder)
    sizes = table(spark, folder, "pack_sizes").orderBy("capacity_tokens").collect()  # a fixed table of three rows
    return reduce(DataFrame.unionByName, [packing.pack(counts, r.pack_name, r.capacity_tokens) for r in sizes])


def p8_report(spark: SparkSession, folder: str) -> DataFrame:
    """Containers and fill of every capacity."""
    return packing.report(p8_packed(spark, folder), table(spark, folder, "pack_sizes"))


def p9_mixture(spark: SparkSession, folder: str) -> DataFrame:
    """The largest mixture with every source at its share."""
    prepare(spark)
    counts = _counts(spark, folder)
    targets = table(spark, folder, "mix_targets").collect()  # a fixed table of eight rows
    return mixing.mixture(counts, [(r.source, r.target_share, r.max_repeats) for r in targets])


def p9_report(spark: SparkSession, folder: str) -> DataFrame:
    """Target and reached shares."""
    return mixing.report(p9_mixture(spark, folder), table(spark, folder, "mix_targets"))


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with a stretch read in the wrong encoding."""
    prepare(spark)
    return mojibake.garbled(spread(table(spark, folder, "documents").select("doc_id", "text"))).select("doc_id")


def p10_restored(spark: SparkSession, folder: str) -> DataFrame:
    """The affected documents, restored where nothing was lost."""
    prepare(spark)
    return mojibake.garbled(spread(table(spark, folder, "documents").select("doc_id", "text")))


QUERIES = {
    "p2_found": p2_found,
    "p2_clean": p2_clean,
    "p3_found": p3_found,
    "p3_pieces": p3_pieces,
    "p3_files": p3_files,
    "p4_found": p4_found,
    "p4_units": p4_units,
    "p5_found": p5_found,
    "p5_turns": p5_turns,
    "p6_found": p6_found,
    "p7_found": p7_found,
    "p7_segments": p7_segments,
    "p8_packed": p8_packed,
    "p8_report": p8_report,
    "p9_mixture": p9_mixture,
    "p9_report": p9_report,
    "p10_found": p10_found,
    "p10_restored": p10_restored,
}

SQL: dict[str, str] = {
    "p3_found": "SELECT payload_id FROM payloads WHERE length(source_text) > 300",
}
