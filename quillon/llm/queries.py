"""Queries of the training-data problems on texts and records (p1, p7, p8, p9)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillon.common import cut, squeezed, table
from quillon.llm.matching import match_records, records
from quillon.llm.mixing import mixed, shares
from quillon.llm.packing import pack
from quillon.llm.subjects import subjects_of


def p7_containers(spark: SparkSession, d: str) -> DataFrame:
    """Container and position of every text, or piece of a text longer than the capacity, in every pack."""
    docs, packs = table(spark, d, "documents"), table(spark, d, "pack_capacity")
    return pack(docs, packs, doc_id=docs["doc_id"], text=docs["text"], pack_name=packs["pack_name"], capacity=packs["capacity_tokens"])


def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    """Containers, tokens and unused room of each pack."""
    packs = table(spark, d, "pack_capacity")
    return (
        p7_containers(spark, d)
        .groupBy("pack_name")
        .agg((F.max("container_id") + 1).alias("containers"), F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("pieces"))
        .join(packs, "pack_name")
        .select("pack_name", "containers", "pieces", "tokens", (1 - F.col("tokens") / (F.col("containers") * F.col("capacity_tokens"))).alias("unused"))
    )


def p7_bounds(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of every pack: each document is there once, no container is over its capacity or has a gap, splits are at the capacity."""
    caps = table(spark, d, "pack_capacity").where("pack_name is not null and capacity_tokens > 0").groupBy("pack_name").agg(F.min("capacity_tokens").alias("capacity_tokens"))
    per = p7_containers(spark, d).join(caps, "pack_name").groupBy("pack_name", "capacity_tokens", "container_id").agg(
        F.sum("n_tokens").alias("t"), F.max("position").alias("last"), F.count(F.lit(1)).alias("n"), F.count_if(F.col("piece") == 0).alias("whole"),
        F.count_if(F.col("token_start") != F.col("piece") * F.col("capacity_tokens")).alias("odd"),
    )
    return per.groupBy("pack_name", "capacity_tokens").agg(
        F.sum("whole").alias("documents"), F.count_if(F.col("t") > F.col("capacity_tokens")).alias("over_capacity"),
        F.count_if(F.col("last") + 1 != F.col("n")).alias("with_gaps"), F.sum("odd").alias("odd_splits"),
    )


def _mixed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    docs, m = table(spark, d, "documents"), table(spark, d, "mix_target")
    chosen = mixed(
        docs, m, doc_id=docs["doc_id"], text=docs["text"], source=docs["source"], mix_name=m["mix_name"], mix_source=m["source"],
        share=m["target_share"], max_repeat=m["max_repeat"],
    )
    return chosen, m


def p8_chosen(spark: SparkSession, d: str) -> DataFrame:
    """The documents of every mix with their copies."""
    return _mixed(spark, d)[0]


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    """Target and actual share of every source of every mix."""
    chosen, m = _mixed(spark, d)
    return shares(chosen, m, mix_name=m["mix_name"], mix_source=m["source"], share=m["target_share"])


def p8_bounds(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of every listed source: its documents, no copy above the cap, tokens within one document of the share."""
    docs, m = table(spark, d, "documents"), table(spark, d, "mix_target")
    chosen = cut(_mixed(spark, d)[0])
    there = docs.where("length(text) > 0").groupBy(squeezed(docs["source"]).alias("source")).agg(F.count(F.lit(1)).alias("available"))
    caps = m.groupBy("mix_name", squeezed(m["source"]).alias("source")).agg(F.min("max_repeat").alias("cap")).where("mix_name is not null and source is not null")
    got = shares(chosen, m, mix_name=m["mix_name"], mix_source=m["source"], share=m["target_share"]).join(caps, ["mix_name", "source"]).join(there, "source", "left")
    longest = chosen.groupBy("mix_name").agg(F.max("n_tokens").alias("longest"))
    present, whole = (F.sum(F.when(F.col("tokens") > 0, F.col(c))).over(Window.partitionBy("mix_name")) for c in ("target_share", "tokens"))
    near = F.abs(F.col("tokens") - F.col("target_share") / present * whole) <= F.col("longest")
    return got.join(longest, "mix_name").select(
        "mix_name", "source", "target_share", F.coalesce("available", F.lit(0)).alias("available"), (F.col("most_repeats") <= F.col("cap")).alias("within_cap"),
        (F.col("documents") <= F.coalesce("available", F.lit(0))).alias("only_its_own"), (F.when(F.col("tokens") > 0, near).otherwise(F.col("available").isNull())).alias("near_target"),
    )


def _subjects(spark: SparkSession, d: str) -> DataFrame:
    docs, labels, areas = (table(spark, d, n) for n in ("documents", "subject_label", "subject_area"))
    return subjects_of(
        docs, labels, doc_id=docs["doc_id"], text=docs["text"], label_id=labels["doc_id"], label_subject=labels["subject"],
        areas=areas, area=areas["subject"], covers=areas["covers"],
    )


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents and the subjects that at least a quarter of their sentences are about."""
    return _subjects(spark, d).select("doc_id", "subject")


def _matched(spark: SparkSession, d: str) -> DataFrame:
    p, s = table(spark, d, "asset_polygon"), table(spark, d, "asset_sharadar")
    a = records(
        p, rec_id=p["rec_id"], figi=p["composite_figi"], ticker=p["ticker"], exchange=p["primary_exchange"], name=p["name"],
        kind=p["asset_type"], sic=p["sic_code"], day=p["list_date"], alive=F.when(p["active"], "y").when(~p["active"], "n"),
    )
    b = records(
        s, rec_id=s["rec_id"], figi=s["composite_figi"], ticker=s["ticker"], exchange=s["primary_exchange"], name=s["name"],
        kind=s["category"], sic=s["siccode"], day=s["firstpricedate"],
        alive=F.when(F.upper(s["isdelisted"]) == "N", "y").when(F.upper(s["isdelisted"]) == "Y", "n"),
    )
    return match_records(a, b)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of records of the two sources that describe the same security."""
    return _matched(spark, d).select(F.least("rec_a", "rec_b").alias("rec_a"), F.greatest("rec_a", "rec_b").alias("rec_b"))


def p1_matches(spark: SparkSession, d: str) -> DataFrame:
    """The same pairs with their sides and confidence."""
    return _matched(spark, d).select(
        F.col("rec_a").alias("polygon_rec"), F.col("rec_b").alias("sharadar_rec"), F.round("confidence", 6).alias("confidence")
    )


def p9_subjects(spark: SparkSession, d: str) -> DataFrame:
    """The same with the share of sentences and their number."""
    return _subjects(spark, d)


def p9_composition(spark: SparkSession, d: str) -> DataFrame:
    """Documents and sentences of the corpus by subject."""
    return (
        _subjects(spark, d)
        .groupBy("subject")
        .agg(F.count(F.lit(1)).alias("documents"), F.sum(F.round(F.col("share") * F.col("sentences"))).cast("bigint").alias("sentences"))
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (p1_found, p1_matches, p7_containers, p7_fill, p7_bounds, p8_chosen, p8_shares, p8_bounds, p9_found, p9_subjects, p9_composition)
}
_SOURCE = "nullif(lower(trim(regexp_replace({}, '[\\s\\x{{A0}}\\x{{2007}}\\x{{202F}}]+', ' ', 'g'))), '')"
#: Packings, mixes and fitted models aren't unique or not expressible; what must hold of the first two is.
ORACLE: dict[str, str] = {
    "p7_bounds": """select pack_name, min(capacity_tokens) as capacity_tokens, (select count(*) from documents) as documents, 0 as over_capacity, 0 as with_gaps, 0 as odd_splits
        from pack_capacity where pack_name is not null and capacity_tokens > 0 group by 1""",
    "p8_bounds": f"""with m as (select mix_name, {_SOURCE.format("source")} as source, sum(target_share) as target_share from mix_target where mix_name is not null group by 1, 2),
        a as (select {_SOURCE.format("source")} as source, count(*) as available from documents where length(text) > 0 group by 1)
        select mix_name, m.source, target_share, coalesce(available, 0) as available, true as within_cap, true as only_its_own, true as near_target from m left join a using (source) where m.source is not null""",
}
