"""Services of series by name, with the known services as a table: one list per tenant, none compiled into the plan.

Each distinct name is taken apart into its prefixes, and the prefixes are joined to the services.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from mendstream import fixed
from mendstream.functions.scalars import fault_groups


def series_map(series: DataFrame, services: DataFrame, families: dict[str, list[str]] = fixed.FAULT_TOKENS) -> DataFrame:
    """tenant_id, series, _service, _prefix, _fault of distinct (tenant_id, series).

    ``services``: ``tenant_id, service, ord``. ``_service``: the longest service that ends at an underscore or at the end of the name, whatever the case, else the text
    before the first underscore. ``_prefix``: the service of the least ``ord`` that the name starts with, null if none. ``_fault``: the first family with a token in what follows the service, cpu if none.
    """
    key = ["tenant_id", "series"]
    parts = F.split(F.lower("series"), "_")
    cuts = series.select(*key, F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "_"))).alias("_low"))
    known = services.select("tenant_id", F.lower("service").alias("_low"), "service")
    longest = cuts.join(known, ["tenant_id", "_low"]).groupBy(*key).agg(F.max_by("service", F.length("_low")).alias("_known"))
    heads = series.select(*key, F.explode(F.transform(F.sequence(F.lit(1), F.length("series")), lambda n: F.col("series").substr(F.lit(1), n))).alias("service"))
    starts = heads.join(services.select("tenant_id", "service", "ord"), ["tenant_id", "service"]).groupBy(*key).agg(F.min_by("service", "ord").alias("_prefix"))
    d = series.select(*key).join(longest, key, "left").join(starts, key, "left")
    service = F.coalesce("_known", F.substring_index("series", "_", 1))
    rest = F.lower("series").substr(F.length(service) + 1, F.length("series"))
    return d.select(*key, service.alias("_service"), "_prefix", F.coalesce(F.get(fault_groups(F.regexp_replace(rest, "^_", ""), families), F.lit(0)), F.lit("cpu")).alias("_fault"))


def named_signals(points: DataFrame, services: DataFrame, shared: tuple[str, ...] = ("redis", "frontend")) -> DataFrame:
    """``points`` (``tenant_id, service, signal_name``) with ``series``: the signal itself if it already starts with a service of the tenant that is not ``shared``, else
    ``service_signal``."""
    signals = points.select("tenant_id", "signal_name").distinct()
    heads = signals.select("tenant_id", "signal_name", F.explode(F.transform(F.sequence(F.lit(1), F.length("signal_name")), lambda n: F.col("signal_name").substr(F.lit(1), n))).alias("service"))
    own = heads.join(services.where(~F.col("service").isin(*shared)).select("tenant_id", "service"), ["tenant_id", "service"]).select("tenant_id", "signal_name").distinct().withColumn("_own", F.lit(True))
    name = F.when(F.col("_own"), F.col("signal_name")).otherwise(F.concat_ws("_", "service", "signal_name"))
    return points.join(own, ["tenant_id", "signal_name"], "left").withColumn("series", name).drop("_own")
