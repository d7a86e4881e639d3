"""The ads catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmeter.schemas import AD, CATALOG_DOCUMENT


def load_catalog(spark: SparkSession, path: str | list[str], created_at: str) -> DataFrame:
    """Ads of one or more catalog documents; of ads listed twice the last one counts."""
    listed = (
        spark.read.schema(CATALOG_DOCUMENT)
        .option("multiLine", True)
        .json(path)
        .select(F.col("_metadata.file_path").alias("file"), F.posexplode("ads"))
        .select(F.struct("file", "pos").alias("position"), "col.*")
        .withColumn("created_at", F.lit(created_at))
    )
    return _last_per_ad(listed)


def upsert_ads(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Stored ads with the new ones put in, replacing those of the same id."""
    columns = AD.fieldNames()
    return _last_per_ad(
        stored.select(F.lit(0).alias("position"), *columns).unionByName(
            new.select(F.lit(1).alias("position"), *columns)
        )
    )


def _last_per_ad(ads: DataFrame) -> DataFrame:
    rest = [name for name in AD.fieldNames() if name != "ad_id"]
    return (
        ads.groupBy("ad_id")
        .agg(F.max(F.struct("position", *rest)).alias("ad"))
        .select("ad_id", *[f"ad.{name}" for name in rest])
    )


def catalog_findings(ads: DataFrame) -> DataFrame:
    """Ads that break a catalog rule, with the rules they break."""
    findings = F.array_compact(
        F.array(
            F.when(F.coalesce("campaign_id", F.lit("")) == "", "campaign_id is required"),
            F.when(F.coalesce("advertiser_id", F.lit("")) == "", "advertiser_id is required"),
            F.when(
                ~F.coalesce(F.col("destination_url").rlike("^https://[^/\\s]+"), F.lit(False)),
                "destination_url must be absolute https",
            ),
        )
    )
    return ads.withColumn("findings", findings).where(F.size("findings") > 0)
