"""Tag lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions import normalise_tag, python_strip


def tag_list(lines: DataFrame) -> DataFrame:
    """``lines`` (site, pos, line) to (site, pos, tag): blank and ``#`` lines skipped, the
    first position of a tag kept."""
    text = python_strip("line")
    kept = lines.where((text != "") & ~text.startswith("#"))
    return kept.select("site", "pos", normalise_tag("line").alias("tag")).groupBy("site", "tag").agg(
        F.min("pos").alias("pos")
    )


def read_tag_files(spark: SparkSession, files: dict[str, str]) -> DataFrame:
    """Tag lists of several sites, ``files`` mapping site to path. A list is a small
    configuration file, so each is read as one text to keep its line numbers."""
    parts = [
        spark.read.text(path, wholetext=True).select(
            F.lit(site).alias("site"), F.posexplode(F.split("value", r"\r\n|\r|\n")).alias("pos", "line")
        )
        for site, path in files.items()
    ]
    lines = parts[0]
    for part in parts[1:]:
        lines = lines.unionByName(part)
    return tag_list(lines)


def inline_tags(text: Column | str) -> Column:
    """Comma-separated tags as an array, in order, without repeats. Text without any tag
    is an error."""
    c = F.col(text) if isinstance(text, str) else text
    cleaned = F.array_distinct(F.filter(F.transform(F.split(c, ","), normalise_tag), lambda t: t != ""))
    problem = F.raise_error(F.lit("the tag list must contain at least one comma-separated tag"))
    return F.when(c.isNull(), None).when(F.size(cleaned) > 0, cleaned).otherwise(problem)


def parse_inline_tags(spark: SparkSession, text: str, sites: DataFrame) -> DataFrame:
    """One inline list used for every given site, in place of its tag file."""
    return sites.select("site", F.posexplode(inline_tags(F.lit(text))).alias("pos", "tag")).select("site", "tag", "pos")
