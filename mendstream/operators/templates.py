"""Log templates: masked messages clustered by token similarity, and their counts over time."""
from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, Window as W, functions as F

from mendstream import fixed
from mendstream.functions.scalars import is_error_log, mask_log
from mendstream.operators.scans import map_runs
from mendstream.session import reuse

WILD = "<*>"


class TemplateIndex:
    """Templates of one leaf, all of the same number of tokens, found by the tokens that stand at their places.

    A message joins the most similar template; of equally similar ones that with more wildcards, then the older one. It can only join one
    that shares a least number of its tokens, so it meets the templates listed under its rarest (place, token) pairs, one pair more than it may miss.
    """

    def __init__(self, similarity: float):
        self.similarity = similarity
        self.templates: list[list[str]] = []
        self.wild: list[int] = []
        self.listed: dict[tuple[int, str], set[int]] = {}

    def candidates(self, tokens: list[str]) -> Iterable[int]:
        need = max(math.ceil(self.similarity * len(tokens) - 1e-9), 0)
        if need == 0:
            return range(len(self.templates))
        lists = sorted((self.listed.get(pair, ()) for pair in enumerate(tokens)), key=len)
        return set().union(*lists[: len(tokens) - need + 1])

    def add(self, tokens: list[str]) -> list[str]:
        """The template that the message joins or opens, changed so that it fits."""
        best, at = (0.0, -1, 0), None
        for k in self.candidates(tokens):
            same = sum(a == b for a, b in zip(self.templates[k], tokens) if a != WILD)
            key = (same / max(len(tokens), 1), self.wild[k], -k)
            if key > best and key[0] >= self.similarity:
                best, at = key, k
        if at is None:
            at = len(self.templates)
            self.templates.append(list(tokens))
            self.wild.append(sum(t == WILD for t in tokens))
            for pair in enumerate(tokens):
                if pair[1] != WILD:
                    self.listed.setdefault(pair, set()).add(at)
            return self.templates[at]
        template = self.templates[at]
        for i, (a, b) in enumerate(zip(template, tokens)):
            if a != b and a != WILD:
                template[i] = WILD
                self.wild[at] += 1
                self.listed[i, a].discard(at)
        return template


def distinct_messages(logs: DataFrame, keys: list[str] = ["tenant_id"]) -> DataFrame:
    """keys, container_name, masked, first_seq, n, level (of the first line): one row per distinct masked message."""
    masked = mask_log(F.concat_ws(" ", "container_name", "message"))
    return (
        logs.select(*keys, "container_name", masked.alias("masked"), "seq", "level")
        .groupBy(*keys, "container_name", "masked")
        .agg(F.min("seq").alias("first_seq"), F.count("*").alias("n"), F.min_by("level", "seq").alias("level"))
    )


def cluster_messages(distinct: DataFrame, similarity: float = fixed.TEMPLATE_SIMILARITY,
                     keys: list[str] = ["tenant_id"]) -> tuple[DataFrame, DataFrame]:
    """(messages, templates) of ``distinct_messages``.

    ``messages``: one row per distinct masked message of a container with its ``template_id``.
    ``templates``: ``template_id, pattern, first_pattern, is_error, container_name, n``; the error flag
    is decided by the first message of a template. With the window among ``keys`` every window has templates of its own.

    Messages can share a template only inside a leaf (container, token count), so leaves are independent; each is clustered in
    first-seen order, as the order decides the templates. A task streams the distinct masked messages of a leaf and holds its templates.
    """
    leaf = [*keys, "container_name", "n_tokens"]
    key_ddl = ", ".join(f"{k} {distinct.schema[k].dataType.simpleString()}" for k in keys)
    leaf_ddl = f"{key_ddl}, container_name string, n_tokens int"

    def cluster(key: tuple, rows: list[tuple]) -> Iterator[tuple]:
        index = TemplateIndex(similarity)
        joined = [index.add(r[0].split()) for r in rows]
        for r, template in zip(rows, joined):
            yield (*key, *r, " ".join(template))

    sized = distinct.withColumn("n_tokens", F.size(F.split(F.trim("masked"), r"\s+")))
    # both results read it
    named = reuse(map_runs(sized.select(*leaf, "masked", "first_seq", "n", "level"), leaf, ["first_seq", "masked"], cluster,
                           f"{leaf_ddl}, masked string, first_seq long, n long, level string, pattern string"))
    template_id = F.substring(F.sha2(F.concat_ws("#", *keys, "container_name", "pattern"), 256), 1, 16)
    messages = named.withColumn("template_id", template_id)
    templates = messages.groupBy(*keys, "template_id", "pattern", "container_name").agg(
        F.sum("n").alias("n"), F.min_by("level", "first_seq").alias("_level"), F.min_by("masked", "first_seq").alias("first_pattern")
    ).withColumn("is_error", is_error_log(F.col("first_pattern"), F.col("_level"))).drop("_level")
    return messages.select(*keys, "container_name", "masked", "template_id"), templates


def mine_templates(logs: DataFrame, similarity: float = fixed.TEMPLATE_SIMILARITY,
                   keys: list[str] = ["tenant_id"]) -> tuple[DataFrame, DataFrame]:
    """(messages, templates) of log lines, see ``cluster_messages``."""
    return cluster_messages(distinct_messages(logs, keys), similarity, keys)


def template_counts(logs: DataFrame, messages: DataFrame, width: int, window: int,
                    keys: list[str] = ["tenant_id"]) -> DataFrame:
    """Log lines per (window, bin, template); only bins with lines, see ``dense_counts`` for the grid."""
    masked = mask_log(F.concat_ws(" ", "container_name", "message"))
    binned = (
        logs.select(*keys, "container_name", masked.alias("masked"), F.expr(f"t div {window}").alias("window_id"),
                    F.expr(f"(t div {width}) * {width}").alias("t"))
        .groupBy(*keys, "container_name", "masked", "window_id", "t").agg(F.count("*").alias("n"))
    )
    return (
        binned.join(messages, [*keys, "container_name", "masked"])
        .groupBy(*keys, "window_id", "t", "template_id").agg(F.sum("n").alias("n"))
    )


def dense_counts(counts: DataFrame, times: DataFrame, keys: list[str] = ["tenant_id"]) -> DataFrame:
    """Zero-filled grid over the metric rows (``times``: window, t, row) x the templates of the window."""
    win = [*keys, "window_id"]
    names = counts.select(*win, "template_id").distinct()
    return (
        times.join(names, win).join(counts, [*win, "t", "template_id"], "left")
        .withColumn("n", F.coalesce("n", F.lit(0)).cast("double"))
    )
