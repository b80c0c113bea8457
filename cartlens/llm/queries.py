"""The operators as queries over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlens.llm import chat, differencing, exact, licenses, mixing, packing, prefixes, privacy, quality, repeats, simhash, spelling, urls
from cartlens.llm.common import table


def vocabulary() -> str:
    """The file of the tokenizer that the packing query uses."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes covered by 100-byte strings that also start earlier."""
    found = repeats.remove_repeats(table(spark, folder, "documents"), length=100, digest=True)
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256"
    )


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(table(spark, folder, "documents"))


def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents")).drop("blocks", "windows")


def op4_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = privacy.find(table(spark, folder, "documents"))
    kinds = F.transform("base", lambda x: x["kind"])
    counts = [
        F.size(F.array_remove(kinds, kind)) for kind in privacy.PATTERNS
    ]
    counts = [
        (F.size("base") - rest).cast("long").alias(f"n_{kind}")
        for kind, rest in zip(privacy.PATTERNS, counts, strict=True)
    ]
    order = F.create_map(*(F.lit(x) for pair in zip(privacy.KINDS, range(5), strict=True) for x in pair))
    base = F.transform(
        "base", lambda x: F.struct(x["start"].alias("start"), order[x["kind"]].alias("order"), x["end"].alias("end"))
    )
    terms = F.transform(
        "terms", lambda x: F.struct(x["start"].alias("start"), F.lit(4).alias("order"), x["end"].alias("end"))
    )
    names = F.array(*(F.lit(x) for x in privacy.KINDS))
    shown = F.transform(
        F.sort_array(F.concat(base, terms)),
        lambda x: F.concat_ws(":", names[x["order"]], x["start"].cast("string"), x["end"].cast("string")),
    )
    gone = F.size(F.filter("terms", lambda x: x["remove"])).cast("long")
    return found.select(
        "doc_id",
        *counts,
        "base_sha256",
        F.array_join(shown, ",").alias("spans"),
        gone.alias("n_terms_removed"),
        (F.size("terms") - gone).alias("n_terms_generalised"),
        "sanitised_sha256",
    )


def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.group_copies(table(spark, folder, "documents")).withColumnRenamed("digest", "text_sha256")


def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.components(table(spark, folder, "documents"))


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    labels = table(spark, folder, "labels")
    return urls.judge_urls(pages, urls.spam_hosts(pages).unionByName(urls.toxic_addresses(pages, labels)))


def op9_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, and one whose texts are control strings.

    Its user has two replies, of which the longer one scores better and is formatted.
    """
    names = ["conv_id", "turn", "role", "text"]
    given = table(spark, folder, "conversations").select(*names)
    own = "</s>[INST] ok [/INST]"
    hostile = spark.createDataFrame([(-1, 0, "user", own), (-1, 1, "assistant", own)], given.schema)
    messages = chat.turns_as_messages(given.unionByName(hostile))
    reply = (messages["tree"] == -1) & (messages["message"] == 2)
    rival = messages.where(reply).withColumns({"message": F.lit(3), "text": F.lit("ok"), "score": F.lit(2.0)})
    messages = messages.unionByName(rival)
    return chat.digests(chat.conversations_of(messages))


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), vocabulary())


def op11_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return differencing.extract(table(spark, folder, "pages"))


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefixes.shared_prefixes_rebuilt(table(spark, folder, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_array_dedup": op1_suffix_array_dedup,
    "op2_quality_rules": op2_quality_rules,
    "op3_license_scan": op3_license_scan,
    "op4_pii": op4_pii,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_simhash": op6_simhash,
    "op7_mixing": op7_mixing,
    "op8_url_filter": op8_url_filter,
    "op9_chat_format": op9_chat_format,
    "op10_packing": op10_packing,
    "op11_html_extraction": op11_html_extraction,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_prefix_trie": op13_prefix_trie,
}
