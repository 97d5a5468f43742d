"""One query per operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import (
    block_search,
    filter_audit,
    langid,
    merkle,
    mixing,
    nn_descent,
    notices,
    pieces,
    pitman_yor,
    quality,
    simhash,
    suffixes,
    warc,
)
from tidewell.llm.common import Scratch, small_batches, table


def op1_license_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = notices.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    return found.select("doc_id", *names, F.size("spans").cast("long").alias("n_spans"))


def op2_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = Scratch(spark, "warc").path
    warc.write(warc.resolve(warc.from_pages(table(spark, sf_dir, "pages"))), archive)
    read = warc.join_originals(warc.read(spark, archive, payloads=False))
    return read.select(
        "page_id",
        "payload_bytes",
        # What the reader took of the payload; the digest in the header is not trusted.
        F.col("actual_digest").alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def op3_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pitman_yor.score(Scratch(spark, "pitman-yor"), docs, pitman_yor.held_out(F.col("doc_id")))


def op4_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = suffixes.cut_repeats(Scratch(spark, "suffixes"), docs)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op5_language_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", langid.held_out(F.col("doc_id")))
    model = langid.train(docs.where("NOT held_out"))
    return langid.identify(docs.select("doc_id", "held_out", "text"), model).drop("text")


def op6_simhash_bk_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "simhash")
    prints = simhash.fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "fp")
    prints = scratch.keep(prints, "documents")
    found = prints.join(simhash.clusters(scratch, prints), "fp")
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op7_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.link(Scratch(spark, "nn-descent"), table(spark, sf_dir, "embeddings"))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "mixing")
    slim = scratch.keep(docs.select("doc_id", "source", mixing.size_of(F.col("text")).alias("size")), "sizes")
    mix = mixing.allot(scratch, slim)
    return mix.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op9_line_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines_removed"
    )


def op10_gumbel_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = pieces.sample_segmentations(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return samples.select(
        "doc_id", "rank", "n_pieces", "log_prob", "perturbed", "log_inclusion", "ids", "round_trip"
    )


def op11_block_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return block_search.search(Scratch(spark, "block-search"), rows, F.col("vec_id") % 20 == 0)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    # Tampering adds 1 to the n_chars of some rows; the proofs are of the rows as they were.
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    changed = merkle.leaf(*fields[:3], F.col("n_chars") + 1, fields[4])
    rows = table(spark, sf_dir, "documents").select(
        merkle.tree_name(F.col("lang")).alias("tree"),
        "doc_id",
        merkle.leaf(*fields).alias("hash"),
        F.when(tampered & F.col("n_chars").isNotNull(), changed).alias("changed"),
    )
    manifest = merkle.Manifest(Scratch(spark, "merkle"), rows, ["doc_id"])
    root = F.lit(manifest.root).cast("string")
    proofs = manifest.proofs().select(
        "doc_id",
        F.col("hash").alias("leaf"),
        "subroot",
        root.alias("root"),
        merkle.proof_digest(F.col("path")).alias("proof_sha256"),
        merkle.folded(F.coalesce("changed", "hash"), F.col("path")).alias("folded_root"),
    )
    return proofs.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return filter_audit.audit(Scratch(spark, "filter-audit"), docs.select("doc_id", "text", "lang"), labels)


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return fn(spark, sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: _query(f)
    for f in (
        op1_license_notices,
        op2_warc_revisits,
        op3_pitman_yor,
        op4_suffix_repeats,
        op5_language_ppm,
        op6_simhash_bk_trees,
        op7_nn_descent,
        op8_mix_sources,
        op9_line_cleaning,
        op10_gumbel_pieces,
        op11_block_search,
        op12_merkle_manifest,
        op13_filter_audit,
    )
}
