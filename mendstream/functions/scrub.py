"""Secrets and personal data removed from text and from nested columns."""
from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from mendstream import fixed


# fixed values: literals (in lower case) of which a text needs one for the rule of this place to match at all
RULE_HINTS = [["bearer"], ["basic"], ["akia", "asia", "aida"], None, ["pass", "pwd", "key", "token"], ["@"], None]


def scrub(text: Column, rules: list[tuple[str, str]] = fixed.SCRUB_RULES) -> Column:
    """All rules in order. A rule whose literal does not occur in the text is not tried."""
    hints = {r[0]: h for r, h in zip(fixed.SCRUB_RULES, RULE_HINTS)}

    def let(c: Column, body: Callable[[Column], Column]) -> Column:
        """Bind a value that ``body`` uses more than once, so that it is computed once."""
        return F.transform(F.array(c), body)[0]

    def one(c: Column, rule: tuple[str, str], low: Column) -> Column:
        words = hints.get(rule[0])
        if not words:
            return F.regexp_replace(c, rule[0], rule[1])
        maybe = reduce(lambda a, b: a | b, [low.contains(w) for w in words])
        return let(c, lambda x: F.when(maybe, F.regexp_replace(x, rule[0], rule[1])).otherwise(x))

    return let(text, lambda t: let(F.lower(t), lambda low: reduce(lambda c, rule: one(c, rule, low), rules, t)))


def _sensitive_name(name: str) -> bool:
    norm = name.lower().replace("-", "_")
    return any(k in norm for k in fixed.SENSITIVE_KEYS)


def _sensitive_key(key: Column) -> Column:
    norm = F.replace(F.lower(key), F.lit("-"), F.lit("_"))
    return reduce(lambda a, b: a | b, [norm.contains(k) for k in fixed.SENSITIVE_KEYS])


def _walk(col: Column, dtype: T.DataType, sensitive: bool, whole: bool) -> Column:
    """``whole`` replaces any value under a sensitive key, otherwise only its string leaves."""
    if sensitive and whole:
        return F.when(col.isNotNull(), F.lit(fixed.SCRUBBED))
    if isinstance(dtype, T.StringType):
        return F.when(col.isNotNull(), F.lit(fixed.SCRUBBED)) if sensitive else scrub(col)
    if isinstance(dtype, T.StructType):
        # a nested object restarts with its own key names
        fields = [_walk(col[f.name], f.dataType, _sensitive_name(f.name), whole).alias(f.name) for f in dtype.fields]
        return F.when(col.isNotNull(), F.struct(*fields))
    if isinstance(dtype, T.ArrayType):
        return F.transform(col, lambda x: _walk(x, dtype.elementType, sensitive, whole))
    if isinstance(dtype, T.MapType) and isinstance(dtype.keyType, T.StringType):
        plain = lambda v: _walk(v, dtype.valueType, False, whole)
        if isinstance(dtype.valueType, T.StringType) or not whole:
            secret = lambda v: _walk(v, dtype.valueType, True, False)
            return F.transform_values(col, lambda k, v: F.when(_sensitive_key(k), secret(v)).otherwise(plain(v)))
        as_text = lambda v: F.to_json(v) if isinstance(dtype.valueType, (T.StructType, T.ArrayType, T.MapType)) else v.cast("string")
        return F.transform_values(col, lambda k, v: F.when(_sensitive_key(k), F.lit(fixed.SCRUBBED)).otherwise(as_text(plain(v))))
    return col


def scrub_struct(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Every string leaf is scrubbed; leaves under a sensitive key are replaced in full."""
    return _apply(df, cols, whole=False)


def scrub_by_keys(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """As :func:`scrub_struct`, but a non-string value under a sensitive key is replaced too."""
    return _apply(df, cols, whole=True)


def _apply(df: DataFrame, cols: list[str] | None, whole: bool) -> DataFrame:
    todo = set(cols or df.columns)
    return df.select(*[
        _walk(F.col(f.name), f.dataType, _sensitive_name(f.name), whole).alias(f.name) if f.name in todo else F.col(f.name)
        for f in df.schema.fields
    ])
