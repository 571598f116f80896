"""Note, word-vector and demographic queries."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from stayframe.functions.expressions import clean_text, tokens
from stayframe.operators import demographics as D
from stayframe.operators import extract as X
from stayframe.operators import text as N
from stayframe.operators.word_vectors import from_table, word_counts
from stayframe.plans import sql_adapters as A
from stayframe.plans.q_cohort import cohort_df
from stayframe.plans.registry import register, round_sql
from stayframe.sources import adapters as ad

CATS = ["user", "assistant", "system", "tool"]
DESCS = ["user", "assistant", "system"]
LANGS = ["en", "fr", "de", "es", "it"]
DOC_CATS = [f"src{i}" for i in range(12)]


def _kept(spark, d):
    return X.extract_notes(ad.notes(spark, d), ad.note_episodes(spark, d), 48.0)


KEPT = """kept AS (
  SELECT n.*, c.admittime, n.charttime IS NULL AS kept_via_chartdate_fallback,
         CASE WHEN n.charttime IS NOT NULL THEN (epoch_us(n.charttime) - epoch_us(c.admittime)) / 3600000000.0 END
           AS hours_since_admit
  FROM notes n JOIN ncohort c ON n.subject_id = c.subject_id AND n.admission_id = c.admission_id
  WHERE coalesce(TRY_CAST(n.iserror AS INTEGER), 0) <> 1
    AND ((n.charttime IS NOT NULL AND n.charttime >= c.admittime AND n.charttime < c.admittime + INTERVAL 48 HOUR)
      OR (n.charttime IS NULL AND n.chartdate BETWEEN CAST(c.admittime AS DATE)
                                                  AND CAST(c.admittime + INTERVAL 1 DAY AS DATE))))"""
NBASE = [A.NOTES, A.NOTE_COHORT, KEPT]


@register("extract_notes_with_date_fallback", round_sql(A.with_(*NBASE) + """
SELECT subject_id, row_id, kept_via_chartdate_fallback, hours_since_admit FROM kept""", ["hours_since_admit"]))
def q_extract_notes(spark, d):
    """Timed rule or date fallback; fallback rows have null hours."""
    return _kept(spark, d).select("subject_id", "row_id", "kept_via_chartdate_fallback", "hours_since_admit")


@register("exclude_error_rows", A.with_(A.NOTES) + """
SELECT count(*) FILTER (WHERE coalesce(iserror, 0) <> 1) AS n_coalesce_rule,
       count(*) FILTER (WHERE iserror IS DISTINCT FROM 1) AS n_distinct_rule, count(*) AS n_all FROM notes""")
def q_exclude_error_rows(spark, d):
    """Both error rules (they agree on integer flags)."""
    n = ad.notes(spark, d)
    a = X.exclude_error_rows(n, variant="coalesce").agg(F.count(F.lit(1)).alias("n_coalesce_rule"))
    b = X.exclude_error_rows(n, variant="distinct").agg(F.count(F.lit(1)).alias("n_distinct_rule"))
    return a.crossJoin(b).crossJoin(n.agg(F.count(F.lit(1)).alias("n_all")))


@register("note_window_stats", round_sql(A.with_(*NBASE) + """
SELECT CASE WHEN kept_via_chartdate_fallback THEN 'chartdate' ELSE 'charttime' END AS path, category,
       count(*) AS n_notes, count(DISTINCT admission_id) AS n_episodes, min(hours_since_admit) AS min_hours,
       quantile_cont(hours_since_admit, 0.5) AS p50_hours, quantile_cont(hours_since_admit, 0.9) AS p90_hours,
       max(hours_since_admit) AS max_hours
FROM kept GROUP BY 1, 2""", ["min_hours", "p50_hours", "p90_hours", "max_hours"]))
def q_note_window_stats(spark, d):
    """X9."""
    return X.note_window_stats(_kept(spark, d))


def _note_block(spark, d):
    return N.note_features(_kept(spark, d), ad.note_episodes(spark, d), CATS, DESCS)


def _nf_sql():
    cats = ", ".join(f"CAST(coalesce(a.\"n_{c}_notes\", 0) AS INTEGER) AS \"n_{c}_notes\"" for c in CATS)
    cat_aggs = ", ".join(f"count(*) FILTER (WHERE category = '{c}') AS \"n_{c}_notes\"" for c in CATS)
    descs = ", ".join(f"coalesce(a.\"has_{x}\", false) AS \"has_{x}\"" for x in DESCS)
    desc_aggs = ", ".join(f"bool_or(coalesce(description = '{x}', false)) AS \"has_{x}\"" for x in DESCS)
    return A.with_(*NBASE, f"""a AS (SELECT subject_id, count(*) AS n_total_notes, {cat_aggs}, {desc_aggs} FROM kept GROUP BY 1)""",
                   """f AS (SELECT subject_id, category AS first_note_category, hours_since_admit AS fh FROM (
  SELECT *, row_number() OVER (PARTITION BY subject_id ORDER BY charttime, category) AS rn FROM kept
  WHERE charttime IS NOT NULL) z WHERE rn = 1)""") + f"""
SELECT c.subject_id, CAST(coalesce(a.n_total_notes, 0) AS INTEGER) AS n_total_notes, {cats},
       coalesce(f.first_note_category, 'NO_CATEGORY') AS first_note_category,
       CAST(coalesce(least(greatest(floor(f.fh), 0), 48), 48) AS INTEGER) AS full_hours_until_first_note, {descs}
FROM (SELECT DISTINCT subject_id FROM ncohort) c LEFT JOIN a ON c.subject_id = a.subject_id
LEFT JOIN f ON c.subject_id = f.subject_id"""


NF = _nf_sql()


@register("note_total", f"SELECT subject_id, n_total_notes FROM ({NF}) t")
def q_note_total(spark, d):
    """N1."""
    return _note_block(spark, d).select("subject_id", "n_total_notes")


@register("note_category_counts", f"SELECT subject_id, {', '.join(chr(34) + f'n_{c}_notes' + chr(34) for c in CATS)} FROM ({NF}) t")
def q_note_category_counts(spark, d):
    """Fixed categories as columns (``tool`` never occurs: zeros)."""
    return _note_block(spark, d).select("subject_id", *[f"n_{c}_notes" for c in CATS])


@register("first_note", f"SELECT subject_id, first_note_category FROM ({NF}) t")
def q_first_note(spark, d):
    """Earliest timed note, ties by category, NO_CATEGORY default."""
    return _note_block(spark, d).select("subject_id", "first_note_category")


@register("hours_to_first_note", f"SELECT subject_id, full_hours_until_first_note FROM ({NF}) t")
def q_hours_to_first_note(spark, d):
    """Floor, clip 0..48, 48 when no timed note."""
    return _note_block(spark, d).select("subject_id", "full_hours_until_first_note")


@register("note_features", NF)
def q_note_features(spark, d):
    """N1-N5 in one aggregation, every cohort subject present."""
    return _note_block(spark, d)


@register("has_description", A.with_(A.DOC_NOTES) + "SELECT subject_id, " + ", ".join(
    f"bool_or(coalesce(description = '{x}', false)) AS \"has_{x}\"" for x in LANGS) + " FROM dnotes GROUP BY 1")
def q_has_description(spark, d):
    """N5 on documents (description = language; ``it`` never occurs)."""
    n = ad.document_notes(spark, d).withColumns(
        {"hours_since_admit": F.lit(None).cast("double"), "charttime": F.lit(None).cast("timestamp_ntz")})
    return N.note_aggregates(n, [], LANGS).select("subject_id", *[f"has_{x}" for x in LANGS])


CLEAN_SQL = r"""regexp_replace(regexp_replace(lower(regexp_replace(coalesce(text, ''), '\[\*\*.*?\*\*\]', ' ', 'g')),
  '^\s+|\s+$', '', 'g'), '[^\p{L}\s]', ' ', 'g')"""


@register("clean_text", f"SELECT doc_id, md5({CLEAN_SQL}) AS clean_md5, length({CLEAN_SQL}) AS clean_len FROM documents")
def q_clean_text(spark, d):
    """N7 on every whole document (compared through md5 and length)."""
    doc = spark.read.parquet(f"{d}/documents.parquet")
    c = clean_text("text")
    return doc.select("doc_id", F.md5(c).alias("clean_md5"), F.length(c).alias("clean_len"))


@register("tokenize", f"""SELECT doc_id, len(list_filter(regexp_split_to_array({CLEAN_SQL}, '\\s+'), lambda x: length(x) > 0)) AS n_tokens
FROM documents""")
def q_tokenize(spark, d):
    """Whitespace tokens of the cleaned text."""
    doc = spark.read.parquet(f"{d}/documents.parquet")
    return doc.select("doc_id", F.size(tokens(clean_text("text"))).cast("bigint").alias("n_tokens"))


@register("category_filter", A.with_(A.DOC_NOTES) + f"""
SELECT category, count(*) AS n FROM dnotes WHERE category IN ({', '.join(repr(c) for c in DOC_CATS)}) GROUP BY 1""")
def q_category_filter(spark, d):
    """N9 with twelve of the twenty sources."""
    return N.category_filter(ad.document_notes(spark, d), DOC_CATS).groupBy("category") \
        .agg(F.count(F.lit(1)).alias("n"))


WORDS_SQL = f"list_filter(regexp_split_to_array({CLEAN_SQL}, '\\s+'), lambda x: length(x) > 0)"


@register("train_word_vectors", f"""SELECT w AS word, true AS finite FROM (SELECT unnest({WORDS_SQL}) AS w FROM documents) t
GROUP BY 1 HAVING count(*) >= 5""")
def q_train_word_vectors(spark, d):
    """A vector of 50 finite numbers for every word with five tokens."""
    doc = N.with_tokens(spark.read.parquet(f"{d}/documents.parquet"))
    model = N.train_word_vectors(doc, vector_size=50, min_count=5)
    finite = F.forall("vector", lambda x: F.abs(x) < float("inf")) & (F.size("vector") == 50)
    return model.vectors().select("word", finite.alias("finite"))


MD5_DIMS = 8
MD5_VECTORS = f"""words AS (SELECT doc_id, {WORDS_SQL} AS ws FROM documents),
vocab AS (SELECT w, [""" + ", ".join(f"CAST('0x' || substr(md5(w), {2 * k + 1}, 2) AS INTEGER) / 256.0" for k in range(MD5_DIMS)) + f"""] AS v
  FROM (SELECT unnest(ws) AS w FROM words) t GROUP BY w HAVING count(*) >= 5),
tokens AS (SELECT doc_id, unnest(ws) AS w FROM words),
sums AS (SELECT doc_id, """ + ", ".join(f"avg(v[{k + 1}]) AS m{k}" for k in range(MD5_DIMS)) + """ FROM tokens JOIN vocab USING (w) GROUP BY 1)"""


def md5_vectors(notes):
    """Vectors that SQL can state too: the bytes of the word's MD5 over 256, for
    every word with five tokens."""
    words = word_counts(notes, 5)
    parts = [F.conv(F.substring(F.md5(F.encode("word", "utf-8")), 2 * k + 1, 2), 16, 10).cast("double") / 256 for k in range(MD5_DIMS)]
    return from_table(words.select("word", F.array(*parts).alias("vector")), MD5_DIMS)


@register("note_vector", round_sql("WITH " + MD5_VECTORS + " SELECT doc_id AS row_id, " + ", ".join(
    f"coalesce(m{k}, 0) AS m{k}" for k in range(MD5_DIMS)) + " FROM documents LEFT JOIN sums USING (doc_id)", [f"m{k}" for k in range(MD5_DIMS)]))
def q_note_vector(spark, d):
    """Mean vector of each note's in-vocabulary tokens, for given vectors."""
    from pyspark.ml.functions import vector_to_array
    notes = N.with_tokens(ad.document_notes(spark, d))
    v = N.note_vectors(notes, md5_vectors(notes)).withColumn("a", vector_to_array("vec"))
    return v.select("row_id", *[F.col("a")[k].alias(f"m{k}") for k in range(MD5_DIMS)])


@register("embedding_block", round_sql(A.with_(A.DOC_NOTES, MD5_VECTORS) + """,
per AS (SELECT n.subject_id, n.admission_id, """ + ", ".join(f"avg(coalesce(m{k}, 0)) AS emb_{k}" for k in range(MD5_DIMS)) + """
  FROM dnotes n LEFT JOIN sums s ON s.doc_id = n.row_id GROUP BY 1, 2) SELECT * FROM per""", [f"emb_{k}" for k in range(MD5_DIMS)]))
def q_embedding_block(spark, d):
    """N14 for given vectors: tokens, note means, episode means, columns."""
    notes = ad.document_notes(spark, d)
    cohort = notes.select("subject_id", "admission_id").distinct()
    return N.embedding_features(notes, cohort, model=md5_vectors(N.with_tokens(notes)))[0]


def _vec_means(spark, d):
    v = ad.vectors(spark, d).withColumn("vec", array_to_vector("vector"))
    return N.mean_vector_by_group(v)


@register("mean_vector_by_group", round_sql("""
SELECT label AS subject_id, i AS dim, avg(CAST(embedding[i] AS DOUBLE)) AS mean_value
FROM embeddings, range(1, 65) r(i) GROUP BY 1, 2""", ["mean_value"]))
def q_mean_vector_by_group(spark, d):
    """Element-wise mean per group (embeddings, group = label)."""
    from pyspark.ml.functions import vector_to_array
    m = _vec_means(spark, d).select("subject_id", F.posexplode(vector_to_array("emb")).alias("pos", "mean_value"))
    return m.select("subject_id", (F.col("pos") + 1).cast("bigint").alias("dim"), "mean_value")


@register("expand_vector", round_sql("SELECT g.subject_id, g.subject_id AS admission_id, " + ", ".join(
    f"avg(CAST(e.embedding[{i + 1}] AS DOUBLE)) AS emb_{i}" for i in range(64))
    + " FROM (SELECT DISTINCT doc_id % 12 AS subject_id FROM documents) g "
      "LEFT JOIN embeddings e ON e.label = g.subject_id GROUP BY 1, 2", [f"emb_{i}" for i in range(64)]))
def q_expand_vector(spark, d):
    """``emb_i`` columns left-joined to a cohort of twelve document
    groups (``doc_id % 12``); groups 10 and 11 have no vectors: nulls."""
    g = spark.read.parquet(f"{d}/documents.parquet").select((F.col("doc_id") % 12).alias("subject_id")).distinct()
    cohort = g.select("subject_id", F.col("subject_id").alias("admission_id"))
    return N.expand_vector(_vec_means(spark, d), cohort, 64)


@register("embedding_features", None)
def q_embedding_features(spark, d):
    """Documents -> tokens -> word vectors (fit once) -> episode
    means -> 200 ``emb_i`` columns per episode (rows-only check)."""
    notes = ad.document_notes(spark, d)
    cohort = notes.select("subject_id", "admission_id").distinct()
    block, _ = N.embedding_features(notes, cohort, vector_size=200)
    return block


# ---- demographics ---------------------------------------------------------------

TD_RULES = [("EQ_GERMANY", "eq", ["germany"]), ("UNITED", "contains", ["united"]),
            ("IA", "contains", ["ia"]), ("AN", "contains", ["an"])]
TD_ATTRS = {
    "gender": ("gender_raw", "upper", None),
    "insurance": ("priority_raw", "lower", ["1-urgent", "2-high", "3-medium", "5-low"]),
    "admission_type": ("status_raw", "upper", ["F", "O"]),
    "admission_location": ("region_raw", "upper", ["AFRICA", "AMERICA", "ASIA", "EUROPE"]),
}


def _demo(spark, d):
    return D.demographics_block(cohort_df(spark, d), ad.subjects(spark, d), ad.episodes(spark, d),
                                attrs=TD_ATTRS, rules=TD_RULES)


ETH_RAW = r"lower(regexp_replace(s.ethnicity_raw, '^\s+|\s+$', '', 'g'))"
DEMO_SQL = A.with_(*A.COHORT_CHAIN) + f"""
SELECT c.subject_id, c.admission_id,
  CAST(year(c.admittime) - year(s.dob) - CASE WHEN month(c.admittime) * 100 + day(c.admittime)
       < month(s.dob) * 100 + day(s.dob) THEN 1 ELSE 0 END AS INTEGER) AS age,
  {ETH_RAW} AS eth_raw,
  CASE WHEN contains({ETH_RAW}, 'an') THEN 'AN' WHEN contains({ETH_RAW}, 'ia') THEN 'IA'
       WHEN contains({ETH_RAW}, 'united') THEN 'UNITED' WHEN {ETH_RAW} = 'germany' THEN 'EQ_GERMANY' END AS eth_broad,
  upper(trim(s.gender_raw)) AS gender,
  CASE WHEN lower(trim(e.priority_raw)) IN ('1-urgent', '2-high', '3-medium', '5-low') THEN lower(trim(e.priority_raw)) END AS insurance,
  CASE WHEN upper(trim(e.status_raw)) IN ('F', 'O') THEN upper(trim(e.status_raw)) END AS admission_type,
  CASE WHEN upper(trim(s.region_raw)) IN ('AFRICA', 'AMERICA', 'ASIA', 'EUROPE') THEN upper(trim(s.region_raw)) END AS admission_location
FROM cohort c LEFT JOIN subjects s ON c.subject_id = s.subject_id LEFT JOIN episodes e ON c.admission_id = e.admission_id"""


@register("demographics_block", DEMO_SQL)
def q_demographics_block(spark, d):
    """Age, ethnicity raw/broad, gender, allow-listed attributes."""
    return _demo(spark, d)


@register("standardise_category", f"SELECT subject_id, gender, eth_raw FROM ({DEMO_SQL}) t")
def q_standardise_category(spark, d):
    """D1."""
    return _demo(spark, d).select("subject_id", "gender", "eth_raw")


@register("allow_list", f"SELECT insurance, admission_type, admission_location, count(*) AS n FROM ({DEMO_SQL}) t GROUP BY 1, 2, 3")
def q_allow_list(spark, d):
    """Outside the list -> null."""
    return _demo(spark, d).groupBy("insurance", "admission_type", "admission_location").agg(
        F.count(F.lit(1)).alias("n"))


@register("rule_classifier", f"SELECT eth_raw, eth_broad, count(*) AS n FROM ({DEMO_SQL}) t GROUP BY 1, 2")
def q_rule_classifier(spark, d):
    """D3: ordered rules, last match wins ('germany' matches eq and 'an')."""
    return _demo(spark, d).groupBy("eth_raw", "eth_broad").agg(F.count(F.lit(1)).alias("n"))


@register("enrich_from_table", A.with_(*A.COHORT_CHAIN) + """
SELECT c.subject_id, c.admission_id, s.gender_raw, s.region_raw, e.priority_raw, e.status_raw
FROM cohort c LEFT JOIN subjects s ON c.subject_id = s.subject_id LEFT JOIN episodes e ON c.admission_id = e.admission_id""")
def q_enrich_from_table(spark, d):
    """One left join per source table for all attributes."""
    c = cohort_df(spark, d).select("subject_id", "admission_id")
    return (c.join(ad.subjects(spark, d).select("subject_id", "gender_raw", "region_raw"), "subject_id", "left")
            .join(ad.episodes(spark, d).select("admission_id", "priority_raw", "status_raw"), "admission_id", "left"))


@register("coarse_group_by_prefix", A.with_(A.SUBJECTS) + """
SELECT subject_id,
  CASE WHEN lower(ethnicity_raw) LIKE 'white%' THEN 'white' WHEN lower(ethnicity_raw) LIKE 'black%' THEN 'black'
       WHEN lower(ethnicity_raw) LIKE 'asian%' THEN 'asian'
       WHEN lower(ethnicity_raw) LIKE 'hisp%' OR lower(ethnicity_raw) LIKE 'latin%' THEN 'hispanic'
       ELSE 'other' END AS eth_coarse,
  CASE WHEN lower(region_raw) LIKE 'white%' THEN 'white' WHEN lower(region_raw) LIKE 'black%' THEN 'black'
       WHEN lower(region_raw) LIKE 'asian%' THEN 'asian'
       WHEN lower(region_raw) LIKE 'hisp%' OR lower(region_raw) LIKE 'latin%' THEN 'hispanic'
       ELSE 'other' END AS region_coarse
FROM subjects""")
def q_coarse_group_by_prefix(spark, d):
    """D6 on every subject's raw group columns (null -> other, Q23)."""
    from stayframe.functions.expressions import coarse_group
    s = ad.subjects(spark, d)
    return s.select("subject_id", coarse_group("ethnicity_raw").alias("eth_coarse"),
                    coarse_group("region_raw").alias("region_coarse"))


@register("prefix_canonicalise", """
WITH v AS (SELECT DISTINCT regexp_replace(lower(p_type), '[^a-z]', '', 'g') AS code FROM part
           UNION SELECT DISTINCT regexp_replace(lower(split_part(p_type, ' ', 1)), '[^a-z]', '', 'g') FROM part)
SELECT a.code, substr(max(lpad(CAST(length(b.code) AS VARCHAR), 9, '0') || b.code), 10) AS canonical
FROM v a JOIN v b ON starts_with(b.code, a.code) WHERE length(a.code) > 0 GROUP BY 1""")
def q_prefix_canonicalise(spark, d):
    """Map each code to its longest observed superstring (codes from
    part types and their first words, so prefixes exist)."""
    p = spark.read.parquet(f"{d}/part.parquet")
    vals = p.select(F.col("p_type").alias("value")).unionByName(
        p.select(F.split("p_type", " ")[0].alias("value")))
    return D.prefix_canonicalise(vals, "value")
