"""Toxicity by a weighted finite-state grammar of clauses.

A text is read as words and clause ends. Each word falls into one class: insult, threat, target, negation, report, quote
mark, clause end or other. Insults are learned: words and word beginnings (stems) that labelled toxic texts hold far more often than other
texts, weighted by their log-odds. Small automata follow the words: one per matter (target seen, threat open,
negation near, speech reported). Their product is one automaton; when a clause ends it hands on the weight of the insults it matched,
filed under the state they were met in. A logistic regression on these clause weights gives the score.

The model is fitted on a bounded sample of the labelled rows (``limit`` texts of each label, by hash of the id).
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from mendstream.llm.common import batch_rows, column

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE, END = range(8)
STEMS = range(3, 8)  # lengths of word beginnings
REACH = 3  # words that a negation covers
TOKEN = regex.compile(r"[\p{L}\p{M}\p{N}]+|[.!?;:\n]|[\"“”„«»]")
# Function words of the grammar in English, German, French and Spanish.
WORDS = {
    THREAT: "kill hurt destroy beat punish töten schlagen vernichten tuer frapper détruire matar golpear destruir",
    TARGET: "you your yourself du dich dir dein ihr euch tu toi te vous votre tú ti usted ustedes vosotros",
    NEGATION: "not never no without nicht kein keine nie ohne ne pas jamais sans nunca jamás sin",
    REPORT: "said says wrote called quoted reported sagte schrieb nannte zitierte dit écrit appelé cité dijo escribió llamó citó",
}
KINDS = [f"{a}{b}" for a, b in product(("plain", "targeted"), ("", "_negated", "_reported", "_both"))] + ["threat"]


def automaton() -> tuple[list[list[int]], list[int]]:
    """The product of the target, threat, negation and reported-speech automata: next state by state and class, and
    the kind under which an insult is filed that ends in a state. Each part is a small automaton over the same classes."""
    target = {OTHER: None, TARGET: 1, END: 0}  # 0 no target in the clause, 1 target seen
    threat = {THREAT: 1, END: 0}
    states = list(product(range(2), range(2), range(REACH + 1), range(2), range(2)))
    index = {s: k for k, s in enumerate(states)}
    step, kind = [], []
    for tg, th, ng, rp, qt in states:
        row = []
        for c in range(8):
            t = target.get(c)
            h = threat.get(c)
            n = REACH if c == NEGATION else 0 if c == END else max(0, ng - 1)
            r = 1 if c == REPORT else 0 if c == END else rp
            q = 1 - qt if c == QUOTE else qt
            row.append(index[(tg if t is None else t, th if h is None else h, n, r, q)])
        step.append(row)
        kind.append(4 * tg + (1 if ng else 0) + (2 if rp or qt else 0))
    return step, kind


def forms(word: str) -> list[str]:
    """The word itself, then its beginnings, longest first; a beginning ends in "-"."""
    return [word, *[word[:k] + "-" for k in reversed(STEMS) if k < len(word)]]


class Grammar:
    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self.step, self.kind = automaton()
        self.fixed = {w: (c, 0.0) for c, ws in WORDS.items() for w in ws.split()}
        self.fixed |= {c: (END, 0.0) for c in ".!?;:\n"} | {c: (QUOTE, 0.0) for c in "\"“”„«»"}
        self.known: dict[str, tuple[int, float]] = {}

    def classify(self, word: str) -> tuple[int, float]:
        for f in forms(word):
            w = self.lexicon.get(f)
            if w is not None:
                return (INSULT, w)
        return self.fixed.get(word, (OTHER, 0.0))

    def features(self, text: str) -> list[float]:
        """Log weight and density of the clauses by kind, and the heaviest clause."""
        words = TOKEN.findall(text.lower())
        if len(self.known) > 1 << 18:
            self.known.clear()
        known = self.known
        for w in set(words):
            if w not in known:
                known[w] = self.classify(w)
        total = [0.0] * len(KINDS)
        if any(known[w][1] for w in set(words)):
            step, kind, state = self.step, self.kind, 0
            clause: dict[int, float] = {}
            peak = threat = 0.0
            for w in [*words, "\n"]:
                c, weight = known.get(w) or self.fixed["\n"]
                if weight:
                    k = kind[state]
                    clause[k] = clause.get(k, 0.0) + weight
                elif c == THREAT:
                    threat = 1.0
                elif c == END and (clause or threat):
                    for k, v in clause.items():
                        total[k] += v
                    peak = max(peak, sum(clause.values()))
                    if threat and clause:
                        total[-1] += threat
                    clause, threat = {}, 0.0
                state = step[state][c]
        else:
            peak = 0.0
        n = len(words) + 20
        return [np.log1p(x) for x in total] + [min(20.0, 100 * x / n) for x in total] + [np.log1p(peak)]


def training_ids(labels: DataFrame, id_col: str, label_col: str, held_out: str, limit: int) -> DataFrame:
    """At most ``limit`` labelled ids of each label, by hash, none that ``held_out`` tells apart."""
    usable = labels.where(f"{id_col} is not null and {label_col} in (0, 1) and not ({held_out})").groupBy(F.col(id_col).alias("_tid")).agg(F.max(label_col).alias("_label"))
    part = [usable.where(F.col("_label") == v).orderBy(F.xxhash64("_tid"), "_tid").limit(limit) for v in (0, 1)]
    return part[0].unionByName(part[1])


def learn_lexicon(sample: DataFrame, least: int = 3, precision: float = 0.5, size: int = 20000) -> dict[str, float]:
    """Weights of words and stems from a bounded sample (_text, _label): forms of ``least`` toxic texts at the least, at least so much ``precision``
    after smoothing; the ``size`` best ones. A form whose longer forms say otherwise is overruled by them at look-up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, tox = [], []
            for text, label in zip(column(batch, "_text").to_pylist(), column(batch, "_label").to_pylist()):
                found = {f for w in set(TOKEN.findall((text or "").lower())) if len(w) > 1 for f in forms(w)}
                out.extend(found)
                tox.extend([label] * len(found))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), pa.array(tox, pa.int32())], names=["form", "tox"])

    counts = sample.groupBy("_label").count().collect()
    n = {r._label: r["count"] for r in counts}
    if not n.get(1):
        return {}
    table = batch_rows(sample, 128).mapInArrow(run, "form string, tox int").groupBy("form").agg(F.sum("tox").alias("a"), (F.count("*") - F.sum("tox")).alias("b")).where(f"a >= {least}")
    share = (F.col("a") + 0.1) / (F.col("a") + F.col("b") + 0.2)
    a, b = (F.col("a") + 0.5) / (n[1] + 1), (F.col("b") + 0.5) / (n.get(0, 0) + 1)
    rows = table.where(share >= precision).withColumn("w", F.log(a / b)).where("w > 0").orderBy(F.desc("w"), "form").limit(size).collect()
    found = {r.form: r.w for r in rows}
    return {f: w for f, w in found.items()}


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 60) -> np.ndarray:
    """Weights and constant by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + ridge * w
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        change = np.linalg.solve(h, g)
        w = w - change
        if np.abs(change).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", held_out: str = "false", limit: int = 8000) -> tuple[dict[str, float], np.ndarray]:
    """(lexicon, weights) from labelled texts. Without any of a label, the score is the share of the other one."""
    ids = training_ids(labels, id_col, label_col, held_out, limit).cache()
    sample = docs.select(F.col(id_col).alias("_tid"), F.col(text_col).alias("_text")).join(F.broadcast(ids), "_tid")  # at most 2 * limit rows
    lexicon = learn_lexicon(sample)
    told = docs.sparkSession.sparkContext.broadcast(lexicon)
    width = 2 * len(KINDS) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = Grammar(told.value)
        for batch in batches:
            x = [g.features(t or "") for t in column(batch, "_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), column(batch, "_label")], names=["x", "y"])

    rows = batch_rows(sample, 128).mapInArrow(run, "x array<double>, y int").toPandas()
    ids.unpersist()
    if not len(rows):
        return lexicon, np.zeros(width + 1)
    return lexicon, fit_logistic(np.array(rows.x.tolist()), rows.y.to_numpy(float))


def score(df: DataFrame, model: tuple[dict[str, float], np.ndarray], text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``df`` with the toxicity of each text, 0 to 1. Null texts count as empty. ``out_col`` replaces a column of that name."""
    told = df.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in df.schema.fields if f.name != out_col]
    schema = StructType([*kept, StructField(out_col, DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, w = told.value
        g = Grammar(lexicon)
        for batch in batches:
            x = np.array([g.features(t or "") for t in column(batch, text_col).to_pylist()]).reshape(batch.num_rows, len(w) - 1)
            p = 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays([*[column(batch, f.name) for f in kept], pa.array(p)], names=schema.names)

    return batch_rows(df).mapInArrow(run, schema)


HELD_OUT = "crc32(cast(doc_id as string)) % 4 = 2"
THRESHOLD = 0.3


def op4(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), held_out=HELD_OUT)
    return score(docs, model).select("doc_id", F.expr(HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
