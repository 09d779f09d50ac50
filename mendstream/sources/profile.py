"""Platform profiles and runbooks as small dimension tables."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from mendstream import fixed
from mendstream.session import exists

RUNBOOK = """name string, description string, pattern_type string,
 action_plan array<struct<step:int,action:string,target:string,params:map<string,string>>>,
 blast_radius_config struct<max_pod_impact_pct:int,circuit_breaker_error_rate:double,allowed_namespaces:array<string>>,
 verify_policy struct<window_seconds:int,success_conditions:array<string>>"""
PROFILE = f"""profile_name string, system string, default_namespace string, default_service string,
 allowed_namespaces array<string>, services array<string>, metric_types array<string>, fault_runbook_mapping map<string,string>,
 dependency_graph map<string,array<string>>, runbooks map<string,struct<{RUNBOOK.replace(' string', ':string').replace(' array', ':array').replace(' struct', ':struct')}>>"""
FLAT = ["name", "pattern_type", "action_plan", "max_pod_impact_pct", "circuit_breaker_error_rate", "allowed_namespaces", "window_seconds", "success_conditions"]


def parse_profiles(df: DataFrame, json: str = "json") -> dict[str, DataFrame]:
    """Profile texts as dimensions keyed by ``profile_name``: services, faults, runbook mapping, edges, runbooks."""
    p = df.select(F.from_json(json, PROFILE).alias("p")).select("p.*")
    key = "profile_name"
    mapping = p.select(key, F.explode("fault_runbook_mapping").alias("fault", "runbook"))
    faults = p.select(key, F.posexplode("metric_types").alias("ord", "fault")).join(mapping, [key, "fault"], "left_semi")
    default = F.coalesce("default_service", F.try_element_at("services", F.lit(1)), F.lit("service"))
    edges = p.select(key, F.explode("dependency_graph").alias("service", "d")).select(key, "service", F.explode("d").alias("depends_on"))
    books = p.select(key, F.explode("runbooks").alias("runbook", "r")).select(key, "runbook", "r.*")
    return {
        "settings": p.select(key, "system", "default_namespace", default.alias("default_service"), "allowed_namespaces"),
        "services": p.select(key, F.posexplode("services").alias("ord", "service")),
        "faults": faults, "mapping": mapping, "edges": edges, "runbooks": books,
    }


def load_platform_profile(spark: SparkSession, paths: str | list[str]) -> dict[str, DataFrame]:
    return parse_profiles(spark.read.text(paths, wholetext=True).withColumnRenamed("value", "json"))


def flat_runbooks(books: DataFrame) -> DataFrame:
    """One row per runbook, with its profile where ``books`` have one."""
    return books.select(
        *[c for c in ["profile_name"] if c in books.columns], "name", F.coalesce("pattern_type", F.lit("urgent")).alias("pattern_type"), "action_plan", "blast_radius_config.max_pod_impact_pct",
        "blast_radius_config.circuit_breaker_error_rate", "blast_radius_config.allowed_namespaces", "verify_policy.window_seconds", "verify_policy.success_conditions")


def catalog_runbooks(spark: SparkSession, namespaces: list[str] | None = None, only_default: bool = False) -> DataFrame:
    """The built-in runbooks; steps act on the namespace of the incident unless they name one."""
    spaces = namespaces or [n[0] for n in fixed.NAMESPACES]
    rows = [
        (name, "urgent", [(1, action, fixed.TARGET_TEMPLATE, params)], fixed.MAX_POD_IMPACT_PCT, fixed.BREAKER_ERROR_RATE, spaces, fixed.VERIFY_WINDOW_SECONDS, conditions)
        for name, action, params, conditions in fixed.RUNBOOKS if not only_default or name == fixed.DEFAULT_RUNBOOK
    ]
    return spark.createDataFrame(
        rows, "name string, pattern_type string, action_plan array<struct<step:int,action:string,target:string,params:map<string,string>>>, max_pod_impact_pct int, "
        "circuit_breaker_error_rate double, allowed_namespaces array<string>, window_seconds int, success_conditions array<string>")


def load_runbooks(spark: SparkSession, profile: DataFrame | None = None, path: str | None = None, catalog: bool = True) -> DataFrame:
    """First available of the profile's runbooks, a runbook file, the built-in catalog, the single default; an absent file is passed over.

    ``profile`` and the file are small configuration; whether the profile has any is asked with one ``take``.
    """
    if profile is not None and profile.take(1):
        return flat_runbooks(profile)
    if path and exists(spark, path):
        text = spark.read.text(path, wholetext=True)
        books = text.select(F.explode(F.from_json("value", f"map<string,struct<{RUNBOOK.replace(' string', ':string').replace(' array', ':array').replace(' struct', ':struct')}>>")).alias("k", "r"))
        return flat_runbooks(books.select("r.*"))
    return catalog_runbooks(spark, only_default=not catalog)


def fault_mapping(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(fixed.FAULT_RUNBOOK.items()), "fault string, runbook string")
