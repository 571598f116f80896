"""Preparation of the assembled matrix (B1-B13): column discovery by name,
category capping, imputation, indicators, log counts, split, weights.

Fitting computes every statistic as distributed aggregates (one pass for
means / null checks, one for top-k counts, one for exact medians); only
those statistics (a few numbers per column) reach the driver. Transforming
is a single projection plus ``VectorAssembler``.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


MISSING = "MISSING"
OTHER = "OTHER"
TOP_K = 40
# Fixed values that must equal the reference: the explicit categorical
# columns.
EXPLICIT_CATEGORICALS = ["eth_raw", "eth_broad", "gender", "insurance", "admission_type", "admission_location"]
NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


@dataclass
class ColumnPlan:
    embeddings: list[str]
    categoricals: list[str]
    count_like: list[str]
    flag_like: list[str]
    other_numerics: list[str]


def discover_columns(df: DataFrame, categoricals: list[str] | None = None,
                     exclude: list[str] | None = None) -> ColumnPlan:
    """B1: blocks by column name (schema scan, no data read). Ids, labels
    (``exclude``) and non-numeric columns outside the categoricals are
    ignored."""
    skip = set(exclude or [])
    cols = [c for c in df.columns if c not in skip]
    types = {f.name: f.dataType for f in df.schema.fields}
    ids = {"subject_id", "admission_id"}
    emb = [c for c in cols if c.startswith("emb_")]
    explicit = EXPLICIT_CATEGORICALS if categoricals is None else categoricals
    cats = [c for c in explicit if c in cols]
    cats += [c for c in cols if c.endswith("_sign_mean")] + [c for c in cols if c == "first_note_category"]
    cats = list(dict.fromkeys(cats))
    counts = [c for c in cols if c.startswith("n_") or c.endswith("_n_admission_measurements")
              or c.endswith("_n_admissions")]
    flags = [c for c in cols if "_any_" in c or c.startswith("no_") or c.startswith("has_")]
    assigned = ids | set(emb) | set(cats) | set(counts) | set(flags)
    other = [c for c in cols if c not in assigned and isinstance(types[c], NUMERIC)]
    return ColumnPlan(emb, cats, counts, flags, other)


def non_null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(position, column, n): the values that are not null in each column, in
    the given order, from one aggregate over the rows."""
    columns = df.columns if columns is None else columns
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{k}") for k, c in enumerate(columns)])
    cells = F.array(*[F.struct(F.lit(k).cast("long").alias("position"), F.lit(c).alias("column"), F.col(f"c{k}").alias("n")) for k, c in enumerate(columns)])
    return counts.select(F.explode(cells).alias("c")).select("c.*")


def to_double(c: str) -> F.Column:
    """Numeric coercion (booleans -> 0/1, text -> try_cast), NaN -> null."""
    x = F.col(f"`{c}`").try_cast("double")
    return F.when(~F.isnan(x), x)


def impute_missing_token(c: str) -> F.Column:
    """B3."""
    return F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(MISSING))


def log1p_count(x: F.Column) -> F.Column:
    """Non-finite -> 0, clip at 0, log1p."""
    finite = F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), F.lit(0.0)).otherwise(x)
    return F.log1p(F.greatest(finite, F.lit(0.0)))


def topk_categories(df: DataFrame, col: str, k: int = TOP_K) -> DataFrame:
    """B2 fit: the ``k`` most frequent values after MISSING imputation,
    ties broken by name (a rank over the small value-count table)."""
    vc = df.groupBy(impute_missing_token(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    top = vc.orderBy(F.desc("n"), F.asc("value")).limit(k)   # distributed top-k, no full sort
    w = Window.orderBy(F.desc("n"), F.asc("value"))           # ranks over k rows only
    return top.withColumn("rank", F.row_number().over(w))


def exact_medians(df: DataFrame, cols: list[str]) -> DataFrame:
    """Exact medians (mean of the two middle values for even counts) of
    many columns at once: unpivot to (column, value), then exact bucketed
    quantiles per column. No column is ever sorted in one task."""
    from stayframe.operators.prefix import exact_quantiles
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, median double")
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), to_double(c).alias("value"))
                                         for c in cols])).alias("kv")).select("kv.*")
    return exact_quantiles(long, ["column"], "value", {"median": 0.5})


@dataclass
class PreparedModel:
    """Fitted statistics; ``transform`` is one projection + assembler."""
    plan: dict
    emb_means: dict = field(default_factory=dict)
    medians: dict = field(default_factory=dict)
    numeric_with_nulls: list = field(default_factory=list)
    categories: dict = field(default_factory=dict)      # column -> seen categories (post MISSING/top-k)
    topk_keep: list = field(default_factory=list)        # values of ``topk_col`` kept by top-k
    topk_col: str = "eth_raw"
    output_columns: list = field(default_factory=list)

    def expressions(self) -> list[F.Column]:
        p = ColumnPlan(**self.plan)
        out: list[F.Column] = []
        names: list[str] = []
        if p.embeddings:
            all_null = F.lit(True)
            for c in p.embeddings:
                all_null = all_null & to_double(c).isNull()
            out.append(all_null.cast("double").alias("emb_missing"))
            names.append("emb_missing")
            for c in p.embeddings:
                out.append(F.coalesce(to_double(c), F.lit(self.emb_means.get(c))).cast("double").alias(c))
                names.append(c)
        for c in p.categoricals:
            v = impute_missing_token(c)
            if c == self.topk_col:
                v = F.when(v.isin(self.topk_keep), v).otherwise(F.lit(OTHER))
            for cat in self.categories.get(c, []):
                nm = f"{c}={cat}"
                out.append((v == F.lit(cat)).cast("double").alias(nm))
                names.append(nm)
        for c in p.count_like:
            out.append(to_double(c).isNull().cast("double").alias(f"missingindicator_{c}"))
            names.append(f"missingindicator_{c}")
        for c in p.count_like:
            out.append(F.coalesce(to_double(c), F.lit(0.0)).alias(c))
            names.append(c)
        for c in p.count_like:
            out.append(log1p_count(F.coalesce(to_double(c), F.lit(0.0))).alias(f"{c}_log1p"))
            names.append(f"{c}_log1p")
        for c in p.flag_like:
            out.append(to_double(c).isNull().cast("double").alias(f"missingindicator_{c}"))
            names.append(f"missingindicator_{c}")
        for c in p.flag_like:
            out.append(F.coalesce(to_double(c), F.lit(0.0)).alias(c))
            names.append(c)
        for c in p.other_numerics:
            med = self.medians.get(c)
            out.append(F.coalesce(to_double(c), F.lit(med).cast("double")).alias(c))
            names.append(c)
        for c in p.other_numerics:
            if c in self.numeric_with_nulls:
                out.append(to_double(c).isNull().cast("double").alias(f"missingindicator_{c}"))
                names.append(f"missingindicator_{c}")
        self.output_columns = names
        return out

    def transform_columns(self, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
        keep = [k for k in (keep or []) if k in df.columns]
        return df.select(*[F.col(k) for k in keep], *self.expressions())

    def transform(self, df: DataFrame, keep: list[str] | None = None, output: str = "features") -> DataFrame:
        """Prepared columns assembled into one vector (positional names so
        any source column name is safe); ``output_columns`` names them."""
        keep = [k for k in (keep or []) if k in df.columns]
        exprs = self.expressions()
        safe = [f"__f{i}" for i in range(len(exprs))]
        kept = [F.col(f"`{k}`") for k in keep]
        wide = df.select(*kept, *[e.alias(n) for e, n in zip(exprs, safe)])
        assembler = VectorAssembler(inputCols=safe, outputCol=output, handleInvalid="keep")
        return assembler.transform(wide).select(*kept, output)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(s: str) -> "PreparedModel":
        return PreparedModel(**json.loads(s))


def fit_preparation(train: DataFrame, plan: ColumnPlan | None = None, topk_col: str = "eth_raw",
                    k: int = TOP_K) -> PreparedModel:
    """Statistics from the training rows only."""
    plan = plan or discover_columns(train)
    stats_cols = []
    for c in plan.embeddings:
        stats_cols.append(F.avg(to_double(c)).alias(f"mean::{c}"))
    for c in plan.other_numerics:
        stats_cols.append(F.max(to_double(c).isNull().cast("int")).alias(f"null::{c}"))
    row = train.agg(*stats_cols).first().asDict() if stats_cols else {}
    means = {k.split("::", 1)[1]: v for k, v in row.items() if k.startswith("mean::")}
    with_nulls = [k.split("::", 1)[1] for k, v in row.items() if k.startswith("null::") and v == 1]
    medians = {r["column"]: r["median"] for r in exact_medians(train, plan.other_numerics).collect()}
    keep = []
    if topk_col in plan.categoricals:
        keep = [r["value"] for r in topk_categories(train, topk_col, k).collect()]
    # one-hot vocabularies of every categorical in one pass (bounded by the
    # number of distinct categories, which is what reaches the driver)
    categories: dict = {c: [] for c in plan.categoricals}
    if plan.categoricals:
        vals = []
        for c in plan.categoricals:
            v = impute_missing_token(c)
            if c == topk_col:
                v = F.when(v.isin(keep), v).otherwise(F.lit(OTHER))
            vals.append(F.struct(F.lit(c).alias("column"), v.alias("value")))
        pairs = train.select(F.explode(F.array(*vals)).alias("kv")).select("kv.*").distinct()
        for r in pairs.collect():
            categories[r["column"]].append(r["value"])
        categories = {c: sorted(v) for c, v in categories.items()}
    return PreparedModel(plan=asdict(plan), emb_means=means, medians=medians, numeric_with_nulls=with_nulls,
                         categories=categories, topk_keep=keep, topk_col=topk_col)


def stratified_split(df: DataFrame, label: str, id_col: str = "subject_id", seed: int = 1407,
                     fractions: tuple[float, float] = (0.70, 0.85)) -> DataFrame:
    """Deterministic stratified 70/15/15 split. Within each label, rows
    are ordered by ``md5(id || '-' || seed)``; the hash prefix (256 values,
    uniform) gives balanced buckets, bucket offsets are summed over at most
    256 rows per label, and the in-bucket position is a window per
    (label, bucket): exact positions without a per-label sort in one task."""
    h = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"-{seed}")))
    d = df.withColumn("__h", h).withColumn("__b", F.conv(F.substring("__h", 1, 2), 16, 10).cast("int"))
    tot = d.groupBy(label, "__b").agg(F.count(F.lit(1)).alias("__c"))
    w_off = Window.partitionBy(label).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select(label, "__b", F.coalesce(F.sum("__c").over(w_off), F.lit(0)).alias("__off"),
                     F.sum("__c").over(Window.partitionBy(label)).alias("__n"))
    w_in = Window.partitionBy(label, "__b").orderBy("__h", id_col)
    d = d.withColumn("__pos", F.row_number().over(w_in) - 1)
    j = d.join(off, [label, "__b"], "inner")
    frac = (F.col("__off") + F.col("__pos")) / F.col("__n")
    split = F.when(frac < fractions[0], "train").when(frac < fractions[1], "val").otherwise("test")
    return j.withColumn("split", split).drop("__h", "__b", "__off", "__n", "__pos", "__c")


def split_label_counts(split_df: DataFrame, label: str) -> DataFrame:
    """B12."""
    return split_df.groupBy("split", label).agg(F.count(F.lit(1)).alias("n"))


def class_weight(split_df: DataFrame, label: str) -> DataFrame:
    """Negatives / positives on train, 1 when there is no positive."""
    t = split_df.where(F.col("split") == "train")
    y = F.col(label).cast("int")
    return t.agg(F.when(F.sum(y) > 0, F.sum(1 - y) / F.sum(y)).otherwise(F.lit(1.0)).alias("scale_pos_weight"))
