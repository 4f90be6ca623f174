"""The registered queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rideflow.llm import audit_sql, near_sql
from rideflow.llm.cap_filters import cap_filter_links
from rideflow.llm.hamming_topk import hamming_topk, sign_code
from rideflow.llm.conflict_packing import conflict_packing
from rideflow.llm.divergence import source_divergence
from rideflow.llm.filter_audit import audit_filters, count_repeats
from rideflow.llm.hilbert import hilbert_shards
from rideflow.llm.main_text import extract_main_text, learn_weights
from rideflow.llm.ngram_join import ngram_join
from rideflow.llm.pareto_mix import fill_shares, n_words, pareto_cuts, pareto_mix, with_copies
from rideflow.llm.positions import with_position
from rideflow.llm.quality_mil import fit_quality, score_quality
from rideflow.llm.rank_profiles import identify_language, learn_profiles
from rideflow.llm.token_files import token_digests, write_token_files
from rideflow.llm.url_rules import apply_url_rules
from rideflow.sources.workdir import materialize, work_dir

CAPACITY = 2048
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"),
         ("net", "/fr/", "block")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op4_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards with equal numbers of rows, along a curve over source, language, length and id."""
    docs = _table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    slim = docs.select("doc_id", "source", "lang", "n_chars", (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    placed = hilbert_shards(slim, ["source", "lang", "n_chars", "doc_id"], 8, law="rows", ties=("text_crc32", "doc_id"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "curve")


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents with Jaccard 0.9 or more on three-word shingles."""
    return ngram_join(_table(spark, sf_dir, "documents"), size=3, percent=90)


def source_targets(sized: DataFrame, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """source, source_size, target: sources in code point order, null last, weigh 3, 1, 2, repeating; together they get `share` of
    all words, each at most `most` times its own, and what one cannot take goes to the others by weight."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = with_position(sources, [F.col("source").isNull(), F.col("source")])
    weights = F.element_at(F.array(*[F.lit(w) for w in (3.0, 1.0, 2.0)]), (F.col("position") % 3 + 1).cast("int"))
    placed = materialize(placed.withColumn("weight", weights).withColumn("cap", F.col("source_size") * most), work_dir(sized.sparkSession))
    total = placed.agg(F.sum("source_size")).first()[0] or 0
    return fill_shares(placed, share * total).select("source", "source_size", "target")


def op1_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    docs = _table(spark, sf_dir, "documents")
    sized = materialize(docs.select("doc_id", "source", n_words(F.col("text")).alias("size")), work_dir(spark))
    targets = materialize(source_targets(sized), work_dir(spark))
    mix = pareto_mix(sized, targets, max_copies=2)
    return (mix.alias("m").join(targets.alias("t"), F.col("m.source").eqNullSafe(F.col("t.source")))
            .select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "m.source", "copies"))


def take_mix(docs: DataFrame) -> DataFrame:
    """The rows of `docs` as often as the mix takes them, with all their columns, whatever their names. An empty table gives no rows."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    sized = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), whole.alias("document"))
    slim = materialize(sized.select("doc_id", "source", "size"), work_dir(docs.sparkSession))
    copies = with_copies(sized, pareto_cuts(slim, source_targets(slim)))
    return copies.where("copies > 0").select("document", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("nth")).select("document.*")


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = _table(spark, sf_dir, "pages")
    found = extract_main_text(pages, learn_weights(pages))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op3_hamming_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest sign codes of every vector whose id is divisible by 20, among all vectors."""
    vectors = _table(spark, sf_dir, "embeddings")
    codes = vectors.select(F.col("vec_id").alias("id"), sign_code(F.col("embedding")).alias("code"))
    return hamming_topk(codes, codes.where("id % 20 = 0"), k=10).withColumnRenamed("id", "vec_id")


def packed(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Documents packed by their words; equal texts are duplicates."""
    slim = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.md5(F.encode("text", "UTF-8")).alias("cluster"))
    return conflict_packing(materialize(slim, work_dir(docs.sparkSession)), capacity)


def op6_conflict_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bins of 2048 words for all documents, with one document of a source and of a set of equal texts each."""
    return packed(_table(spark, sf_dir, "documents"))


def op7_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of one label with cosine 0.98 or more: links, components and which vector of each stays."""
    return cap_filter_links(_table(spark, sf_dir, "embeddings"), threshold=0.98)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text leaves 2 when divided by 4. A null id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def quality_model(spark: SparkSession, sf_dir: str):
    labels = _table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id"))).select("doc_id", F.col("quality").alias("label"))
    return fit_quality(_table(spark, sf_dir, "documents"), labels)


def op8_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from the labels that are not held out."""
    scored = score_quality(_table(spark, sf_dir, "documents"), quality_model(spark, sf_dir))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def language_profiles(spark: SparkSession, sf_dir: str) -> dict[str, list[int]]:
    return learn_profiles(_table(spark, sf_dir, "documents").where(~held_out(F.col("doc_id"))).select("lang", "text"))


def op9_rank_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, by profiles of the documents that are not held out."""
    found = identify_language(_table(spark, sf_dir, "documents"), language_profiles(spark, sf_dir))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page url under nested host rules."""
    rules = spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in RULES])))
    return apply_url_rules(_table(spark, sf_dir, "pages"), rules)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove of the documents of every language, in all 120 orders. A null id repeats no other document."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    text = F.coalesce("text", F.lit(""))
    words = F.array_remove(F.split("t", r"[\x20\x09-\x0D]+"), "")
    capitals = F.length(F.regexp_replace("t", "[^A-Z]+", ""))
    judged = (docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), text.alias("t")).withColumn("words", words)
              .select("doc_id", "part", F.sha2(F.encode("t", "UTF-8"), 256).alias("digest"), (F.size("words") < 200).alias("a"),
                      (100 * F.size(F.array_distinct("words")) < 50 * F.size("words")).alias("b"),
                      (100 * capitals > 3 * F.length("t")).alias("c"), F.col("t").rlike("[#$%&*|]").alias("d")))
    marked = labels.groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    counted = count_repeats(judged.join(marked, "doc_id", "left"), "doc_id", "digest", ["part", "a", "b", "c", "d", "good", "toxic"])
    return audit_filters(counted, {"A": F.col("a"), "B": F.col("b"), "C": F.col("c"), "D": F.col("d"), "E": F.col("repeat")}, F.col("part"),
                         {"good": F.col("good"), "toxic": F.col("toxic")}, F.col("n"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token ids in seekable files, read back: where each lies and a checksum of its ids."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        model = file.read()
    path = work_dir(spark)
    write_token_files(_table(spark, sf_dir, "documents"), path, model)
    return token_digests(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far apart the sources of every language are, and the terms that set each of them off."""
    return source_divergence(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_pareto_mix, op2_main_text, op3_hamming_topk, op4_hilbert_shards, op5_ngram_join, op6_conflict_packing,
                                   op7_cap_filters, op8_quality_mil, op9_rank_profiles, op10_url_rules, op11_filter_audit,
                                   op12_token_files, op13_source_divergence)}
ORACLE = {"op3_hamming_topk": near_sql.HAMMING_TOPK, "op5_ngram_join": near_sql.NGRAM_JOIN, "op7_cap_filters": near_sql.CAP_LINKS,
          "op10_url_rules": near_sql.URL_RULES, "op11_filter_audit": audit_sql.FILTER_AUDIT,
          "op13_source_divergence": audit_sql.SOURCE_DIVERGENCE}
