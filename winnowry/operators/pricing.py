"""Token prices: exact, default and substring lookup."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from winnowry import fixed_values as fv

MAX_PRICE_ROWS = 10_000
PRICE_SCHEMA = "model string, unit_tokens bigint, input_price double, output_price double"


def price_table(spark: SparkSession, prices: tuple = fv.PRICES_PER_MILLION) -> DataFrame:
    if len(prices) > MAX_PRICE_ROWS:
        raise ValueError(f"more than {MAX_PRICE_ROWS} prices: keep them in a table")
    names = ("model", "unit_tokens", "input_price", "output_price")
    columns = zip(*prices, strict=True)
    return spark.createDataFrame(pa.table(dict(zip(names, map(list, columns), strict=True)))).to(
        T.StructType.fromDDL(PRICE_SCHEMA))


def override_prices(defaults: DataFrame, custom: DataFrame) -> DataFrame:
    """Custom prices replace defaults of the same model."""
    return defaults.join(custom, "model", "left_anti").unionByName(custom)


def _amount(input_tokens: Column, output_tokens: Column) -> Column:
    unit = F.col("unit_tokens")
    return input_tokens / unit * F.col("input_price") + output_tokens / unit * F.col("output_price")


def add_cost(usage: DataFrame, prices: DataFrame, input_tokens: str, output_tokens: str,
             model: str = "model", default_price: tuple | None = None, out: str = "cost_usd") -> DataFrame:
    """Cost by exact model; an unknown model costs 0, or ``default_price`` (model, unit, in, out).

    The price side carries no hint: the optimizer broadcasts it when its size allows.
    """
    _, unit, price_in, price_out = default_price or (None, 1, 0.0, 0.0)
    p = prices.select(
        F.col("model").alias("_price_model"), F.col("unit_tokens").alias("_unit"),
        F.col("input_price").alias("_in"), F.col("output_price").alias("_out"))
    joined = usage.join(p, F.col(model) == F.col("_price_model"), "left")
    unit_tokens = F.coalesce("_unit", F.lit(unit))
    cost = (F.col(input_tokens) / unit_tokens * F.coalesce("_in", F.lit(price_in))
            + F.col(output_tokens) / unit_tokens * F.coalesce("_out", F.lit(price_out)))
    return joined.withColumn(out, cost).drop("_price_model", "_unit", "_in", "_out")


def _fold_name(c: Column) -> Column:
    return F.translate(F.lower(c), "-.", "__")


def rule_cost(model: Column, input_tokens: Column, output_tokens: Column,
              rules: tuple = fv.PRICE_RULES) -> Column:
    """Cost by the first rule whose key is part of the model name; 0 when none is.

    The rule list is a short literal, so this is a row-local CASE, not a join; ``cost_by_rules`` takes
    rules of any number.
    """
    if len(rules) > 200:
        raise ValueError("too many price rules for an inline CASE: keep them in a table and use cost_by_rules")
    out = F.when(F.lit(False), F.lit(0.0))
    for key, unit, price_in, price_out, folded in rules:
        name = _fold_name(model) if folded else F.lower(model)
        wanted = key.lower().replace("-", "_").replace(".", "_") if folded else key.lower()
        amount = input_tokens / unit * price_in + output_tokens / unit * price_out
        out = out.when(F.contains(name, F.lit(wanted)), amount)
    return out.otherwise(F.lit(0.0))


def cost_by_rules(usage: DataFrame, rules: DataFrame, model: str, input_tokens: str, output_tokens: str, out: str = "cost_usd") -> DataFrame:
    """Cost by the first rule, in the order of ``rank``, whose ``key`` is part of the model name; 0 when none is.

    ``rules`` has rank, key, unit_tokens, input_price, output_price, folded and any number of rows.  Every
    distinct name lists its parts of the lengths that keys have, and these meet the keys by equality: what
    comes out are true matches alone, where a join on common beginnings would pair all names of a maker
    with all its rules.  The driver receives the distinct lengths.
    """
    wanted = F.when(F.col("folded"), _fold_name(F.col("key"))).otherwise(F.lower("key"))
    ruled = rules.select("rank", wanted.alias("_part"), "folded", F.struct("unit_tokens", "input_price", "output_price").alias("_price")).groupBy(
        "_part", "folded").agg(F.min(F.struct("rank", "_price")).alias("_rule"))
    lengths = sorted(r[0] for r in ruled.select(F.length("_part")).distinct().collect() if r[0] is not None)
    sizes = F.array(*[F.lit(n) for n in lengths]) if lengths else F.array().cast("array<int>")

    def parts(name: Column, folded: bool) -> Column:
        fitting = F.filter(sizes, lambda n: n <= F.length(name))
        found = F.flatten(F.transform(fitting, lambda n: F.transform(
            F.sequence(F.lit(1), F.length(name) - n + 1), lambda at: name.substr(at, n))))
        return F.transform(F.array_distinct(found), lambda p: F.struct(p.alias("_part"), F.lit(folded).alias("folded")))

    names = usage.select(F.col(model).alias("_name")).filter("_name is not null").distinct()
    both = names.select("_name", F.explode(F.concat(parts(F.lower("_name"), False), parts(_fold_name(F.col("_name")), True))).alias("p"))
    best = both.select("_name", "p._part", "p.folded").join(ruled, ["_part", "folded"]).groupBy("_name").agg(F.min("_rule").alias("_rule"))
    price = F.col("_rule")["_price"]
    cost = F.col(input_tokens) / price["unit_tokens"] * price["input_price"] + F.col(output_tokens) / price["unit_tokens"] * price["output_price"]
    return usage.join(best, F.col(model) == F.col("_name"), "left").withColumn(out, F.coalesce(cost, F.lit(0.0))).drop("_name", "_rule")
