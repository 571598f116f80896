"""Note features: counts, first note, description flags (N1-N6) and word
vectors (N7-N14)."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayframe.functions.expressions import clean_text, text_tokens
from stayframe.operators import word_vectors
from stayframe.operators.word_vectors import WordVectors
from stayframe.session import stage

# Fixed values that must equal the reference: the twelve counted note
# categories (trailing spaces included), the three categories used for
# word vectors, and the note descriptions turned into has_* flags.
NOTE_CATEGORIES = ["Radiology", "Nursing/other", "Nursing", "ECG", "Physician ", "Echo", "Respiratory ",
                   "General", "Nutrition", "Social Work", "Rehab Services", "Case Management "]
EMBEDDING_CATEGORIES = ["Nursing", "Nursing/other", "Physician"]
NOTE_DESCRIPTIONS = [
    "Physician Resident Progress Note", "Intensivist Note", "Physician Resident Admission Note",
    "Physician Attending Progress Note", "Physician Attending Admission Note - MICU", "ICU Note - CVI",
    "Physician Surgical Admission Note", "Physician Attending Admission Note",
    "Physician Resident/Attending Progress Note - MICU", "Physician Resident/Attending Admission Note - MICU",
    "Physician Fellow / Attending Progress Note - MICU", "Physician Surgical Progress Note",
    "Cardiology Physician Note", "Cardiology Comprehensive Physician Note",
    "Physician Fellow/Attending Progress Note - MICU", "CHEST (PORTABLE AP)", "CT HEAD W/O CONTRAST",
    "CHEST PORT. LINE PLACEMENT", "CHEST (PRE-OP PA & LAT)", "CHEST (PA & LAT)", "MR HEAD W & W/O CONTRAST",
    "CAROTID SERIES COMPLETE", "PORTABLE ABDOMEN", "CT CHEST W/O CONTRAST", "MR HEAD W/O CONTRAST",
    "CT CHEST W/CONTRAST", "BY DIFFERENT PHYSICIAN", "CT ABDOMEN W/O CONTRAST",
    "CTA CHEST W&W/O C&RECONS, NON-CORONARY", "CTA HEAD W&W/O C & RECONS", "CT ABDOMEN W/CONTRAST",
    "BY SAME PHYSICIAN", "BILAT LOWER EXT VEINS", "CT C-SPINE W/O CONTRAST", "LIVER OR GALLBLADDER US (SINGLE ORGAN)",
    "ABDOMEN U.S. (COMPLETE STUDY)", "MR CERVICAL SPINE W/O CONTRAST", "RENAL U.S.",
    "P LIVER OR GALLBLADDER US (SINGLE ORGAN) PORT", "CT ABD W&W/O C", "P RENAL U.S. PORT", "SEL CATH 3RD ORDER THOR",
    "P BILAT LOWER EXT VEINS PORT", "CTA CHEST W&W/O C &RECONS", "MR CERVICAL SPINE", "T-SPINE",
    "P CAROTID SERIES COMPLETE PORT", "VEN DUP EXTEXT BIL (MAP/DVT)", "DISTINCT PROCEDURAL SERVICE",
    "CTA ABD W&W/O C & RECONS", "CHEST (SINGLE VIEW)", "CT SINUS/MANDIBLE/MAXILLOFACIAL W/O CONTRAST",
    "US ABD LIMIT, SINGLE ORGAN", "CT T-SPINE W/O CONTRAST", "EMBO TRANSCRANIAL", "DUPLEX DOPP ABD/PEL",
    "CT L-SPINE W/O CONTRAST", "CT PELVIS W/CONTRAST", "ABDOMEN (SUPINE & ERECT)", "EMBO NON NEURO",
    "CT PELVIS W/O CONTRAST", "P ABDOMEN U.S. (COMPLETE STUDY) PORT", "MR HEAD W/ CONTRAST",
    "MR C-SPINE W& W/O CONTRAST", "CT HEAD W/ & W/O CONTRAST", "O L-SPINE (AP & LAT) IN O.R.",
    "CTA NECK W&W/OC & RECONS", "P ABDOMEN (SUPINE ONLY) PORT", "ERCP BILIARY&PANCREAS BY GI UNIT",
    "Nursing Progress Note", "Nursing Transfer Note",
]
NO_CATEGORY = "NO_CATEGORY"
WINDOW_HOURS = 48


def note_aggregates(kept: DataFrame, categories: list[str], descriptions: list[str]) -> DataFrame:
    """N1-N5 per subject in one aggregation: total, fixed-category counts,
    first timed note (ties by category) and its hours, description flags."""
    timed = F.col("charttime").isNotNull()
    order = F.struct(F.col("charttime").alias("t"), F.col("category").alias("c"))
    aggs = [F.count(F.lit(1)).alias("n_total_notes")]
    aggs += [F.count_if(F.col("category") == c).alias(f"n_{c}_notes") for c in categories]
    aggs += [F.min_by(F.when(timed, F.col("category")), F.when(timed, order)).alias("first_note_category"),
             F.min_by(F.when(timed, F.col("hours_since_admit")), F.when(timed, order)).alias("first_hours"),
             F.count_if(timed).alias("n_timed")]
    aggs += [F.max(F.coalesce(F.col("description") == d, F.lit(False))).alias(f"has_{d}") for d in descriptions]
    return kept.groupBy("subject_id").agg(*aggs)


def note_features(kept: DataFrame, cohort: DataFrame, categories: list[str] | None = None,
                  descriptions: list[str] | None = None, window_hours: int = WINDOW_HOURS) -> DataFrame:
    """One row per cohort subject; zero counts, ``NO_CATEGORY`` and
    ``window_hours`` defaults for subjects without notes (N1-N5)."""
    categories = NOTE_CATEGORIES if categories is None else categories
    descriptions = NOTE_DESCRIPTIONS if descriptions is None else descriptions
    agg = note_aggregates(kept, categories, descriptions)
    base = cohort.select("subject_id").distinct()
    j = base.join(agg, "subject_id", "left")
    hrs = F.least(F.greatest(F.floor(F.col("first_hours")), F.lit(0)), F.lit(window_hours))
    cols = [F.col("subject_id"), F.coalesce("n_total_notes", F.lit(0)).cast("int").alias("n_total_notes")]
    cols += [F.coalesce(F.col(f"`n_{c}_notes`"), F.lit(0)).cast("int").alias(f"n_{c}_notes") for c in categories]
    cols += [F.coalesce(F.when(F.col("n_timed") > 0, F.col("first_note_category")), F.lit(NO_CATEGORY))
             .alias("first_note_category"),
             F.coalesce(hrs, F.lit(window_hours)).cast("int").alias("full_hours_until_first_note")]
    cols += [F.coalesce(F.col(f"`has_{d}`"), F.lit(False)).alias(f"has_{d}") for d in descriptions]
    return j.select(*cols)


def with_tokens(notes: DataFrame) -> DataFrame:
    """N7 + N8."""
    return notes.withColumns({"clean_text": clean_text("text"), "tokens": text_tokens("text")})


def category_filter(notes: DataFrame, categories: list[str] | None = None, trim: bool = False) -> DataFrame:
    """N9. ``trim=True`` compares trimmed names on both sides (Q15: the
    counted list has ``Physician `` with a trailing space, this list has
    ``Physician``); the default keeps the exact comparison."""
    categories = EMBEDDING_CATEGORIES if categories is None else categories
    if trim:
        return notes.where(F.trim(F.col("category")).isin([c.strip() for c in categories]))
    return notes.where(F.col("category").isin(categories))


def train_word_vectors(tokenised: DataFrame, vector_size: int = 200, window: int = 5, min_count: int = 5, passes: int = 5,
                       written: bool = False) -> WordVectors:
    """Word vectors from skip-gram pair counts (``word_vectors``), the same
    for every partitioning; a note is one sentence, however long. The tokens
    are read by the vocabulary and by the pair counts, so they are written
    once, unless ``written`` says that they are."""
    tokens = tokenised.select("tokens")
    return word_vectors.train(tokens if written else stage(tokens, "tokens"), vector_size, window, min_count, passes)


def note_vectors(tokenised: DataFrame, model: WordVectors, key: str = "row_id") -> DataFrame:
    """Mean of the vectors of in-vocabulary tokens per note (zeros if
    none), row by row and without a shuffle: rows that share an id, or whole
    rows that repeat, do not add up."""
    t = tokenised.select(key, "subject_id", "admission_id", "tokens")
    mean = F.when(F.col("n_in") > 0, F.transform("total", lambda x: x / F.col("n_in"))).otherwise(F.array_repeat(F.lit(0.0), model.size))
    return word_vectors.row_sums(t, model).select(key, "subject_id", "admission_id", array_to_vector(mean).alias("vec"))


def mean_vector_by_group(vectors: DataFrame, vector_col: str = "vec",
                         keys: tuple[str, ...] = ("subject_id", "admission_id")) -> DataFrame:
    """Element-wise mean of note vectors per episode (partial
    aggregation in the JVM)."""
    return vectors.groupBy(*keys).agg(Summarizer.mean(F.col(vector_col)).alias("emb"))


def expand_vector(grouped: DataFrame, cohort: DataFrame, dims: int, vector_col: str = "emb") -> DataFrame:
    """``emb_0..emb_{d-1}`` columns, left-joined to the cohort (null
    when the episode has no notes)."""
    arr = grouped.select("subject_id", "admission_id", vector_to_array(F.col(vector_col)).alias("a"))
    wide = arr.select("subject_id", "admission_id", *[F.col("a")[i].alias(f"emb_{i}") for i in range(dims)])
    base = cohort.select("subject_id", "admission_id").distinct()
    return base.join(wide, ["subject_id", "admission_id"], "left")


def embedding_features(notes: DataFrame, cohort: DataFrame, model: WordVectors | None = None,
                       categories: list[str] | None = None, vector_size: int = 200, min_count: int = 5,
                       fit_notes: DataFrame | None = None) -> tuple[DataFrame, WordVectors]:
    """Tokenise, (fit once on the training notes, Q17), note vectors,
    episode means, expanded columns. Returns (block, model)."""
    n = with_tokens(notes if categories is None else category_filter(notes, categories)) \
        .select("row_id", "subject_id", "admission_id", "tokens")
    if model is None:
        # tokens are read by the vocabulary, the pair counts and the notes' sums: written once
        n = stage(n, "tokens")
        model = train_word_vectors(with_tokens(fit_notes) if fit_notes is not None else n,
                                   vector_size=vector_size, min_count=min_count, written=fit_notes is None)
    dims = model.size
    vecs = note_vectors(n, model)
    return expand_vector(mean_vector_by_group(vecs), cohort, dims), model
