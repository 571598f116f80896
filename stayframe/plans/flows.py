"""End-to-end flows over clinical-shaped sources: cohort -> labels ->
feature blocks -> assembled matrix -> one calibrated model per target ->
scores for unseen subjects. Every step is a lazy DataFrame; only model
fitting and the preparation statistics run jobs."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayframe.operators import assemble as AS
from stayframe.operators import clean as M
from stayframe.operators import cohort as C
from stayframe.operators import demographics as D
from stayframe.operators import extract as X
from stayframe.operators import intervals as P
from stayframe.operators import labels as L
from stayframe.operators import model as T
from stayframe.operators import prepare as B
from stayframe.operators import text as N
from stayframe.operators import timeseries as TS
from stayframe.operators.word_vectors import WordVectors
from stayframe.session import materialize, stage_packed
from stayframe.sources.clinical import typed, with_row_id

TARGETS = {"mortality": "mortality_proba", "prolonged_stay": "prolonged_LOS_proba",
           "readmission": "readmission_proba"}


@dataclass
class Sources:
    """Raw source tables (any column case)."""
    admissions: DataFrame
    patients: DataFrame
    chartevents: DataFrame | None = None
    labevents: DataFrame | None = None
    prescriptions: DataFrame | None = None
    noteevents: DataFrame | None = None


@dataclass
class Config:
    """Item dictionaries (itemid, feature_name, min_bound, max_bound) per
    measurement block, block switches (letters of ``dvlgpne``), model size."""
    dictionaries: dict = field(default_factory=dict)     # block -> (source table, dictionary DataFrame)
    include: dict = field(default_factory=lambda: {"demographics": True, "prescriptions": True})  # notes: off unless asked for
    window_hours: float = 48.0
    n_windows: int = 4
    max_iter: int = T.MAX_ROUNDS
    patience: int = T.PATIENCE     # rounds without a better validation average precision before boosting stops
    embeddings: bool = False
    tuned_weight: bool = True      # Q18: use the tuned positive weight (False: the raw ratio, as the reference)
    vector_size: int = 200
    min_count: int = 5
    unmapped: str = "warn"         # items without a feature name: "warn" keeps them aside, "raise" stops
    exclude_errors: bool = False   # Q20: chart rows flagged as errors stay unless asked otherwise
    w2v_model: object = None       # fitted on the training cohort, reused for scoring


def cohort_for(ids: DataFrame, src: Sources) -> tuple[DataFrame, DataFrame, DataFrame]:
    adm, pat = typed("admissions", src.admissions), typed("patients", src.patients)
    return C.build_cohort(adm, pat, ids), adm, pat


def labels_for(cohort: DataFrame, adm: DataFrame, pat: DataFrame) -> DataFrame:
    m = L.mortality(cohort, adm, pat).select("subject_id", "admission_id", "mortality")
    p = L.prolonged_stay(cohort)
    r = L.readmission(cohort, C.second_episode(cohort, adm)).select("subject_id", "readmission")
    return (m.join(p, ["subject_id", "admission_id"]).join(r, "subject_id")
            .select("subject_id", "admission_id", *[F.col(t).cast("int").alias(t) for t in TARGETS]))


def embedding_block(cohort: DataFrame, src: Sources, cfg: Config, model=None, train_ids: DataFrame | None = None):
    """N14 inside the flow: notes in the closed window (X2) with the
    ``IS DISTINCT FROM 1`` error rule (X4), the three embedding categories,
    word vectors fitted once, on the notes of ``train_ids`` only, and reused
    when scoring (Q17). Returns (block, model)."""
    notes = typed("noteevents", src.noteevents)
    notes = X.exclude_error_rows(notes, variant="distinct")
    kept = X.extract_window(notes, cohort, cfg.window_hours, closed=True).drop("admittime")
    kept = with_row_id(kept)
    fit_notes = None
    if model is None and train_ids is not None:
        fit_notes = N.category_filter(kept, N.EMBEDDING_CATEGORIES).join(train_ids, "subject_id", "left_semi")
    block, model = N.embedding_features(kept, cohort, model=model, categories=N.EMBEDDING_CATEGORIES,
                                        vector_size=cfg.vector_size, min_count=cfg.min_count, fit_notes=fit_notes)
    return block, model


def blocks_for(cohort: DataFrame, adm: DataFrame, pat: DataFrame, src: Sources, cfg: Config,
               w2v=None, train_ids: DataFrame | None = None) -> list[DataFrame]:
    blocks = [cohort.select("subject_id", "admission_id")]
    wh = cfg.window_hours / cfg.n_windows
    if cfg.include.get("demographics"):
        blocks.append(D.demographics_block(cohort, pat, adm).drop("admission_id"))
    for block, (table, dictionary) in cfg.dictionaries.items():
        raw = getattr(src, table)
        if raw is None or not cfg.include.get(block, True):
            continue
        meas = with_row_id(typed(table, raw))
        ext = X.extract_window(meas, cohort, cfg.window_hours, items=dictionary, exclude_errors=cfg.exclude_errors)
        clean = M.alias_feature(M.clean_measurements(ext.drop("admittime"), dictionary, policy=cfg.unmapped))
        feats = sorted({r["feature_name"] for r in
                        M.alias_feature(dictionary.select("feature_name")).distinct().collect()})
        blocks.append(TS.ts_features(clean, cohort, feats, wh, cfg.n_windows).drop("admission_id"))
    if cfg.include.get("prescriptions") and src.prescriptions is not None:
        ov = X.interval_overlap(typed("prescriptions", src.prescriptions), cohort, cfg.window_hours)
        blocks.append(P.interval_features(ov, cohort, window_hours=cfg.window_hours).drop("admission_id"))
    if cfg.include.get("notes") and src.noteevents is not None:
        notes = typed("noteevents", src.noteevents)
        kept = X.extract_notes(notes, cohort, cfg.window_hours)
        blocks.append(N.note_features(kept, cohort, window_hours=int(cfg.window_hours)))
    if cfg.embeddings and src.noteevents is not None:
        block, model = embedding_block(cohort, src, cfg, w2v, train_ids)
        cfg.w2v_model = model
        blocks.append(block.drop("admission_id"))
    return blocks


def training_matrix(ids: DataFrame, src: Sources, cfg: Config) -> DataFrame:
    cohort, adm, pat = cohort_for(ids, src)
    labels = materialize(labels_for(cohort, adm, pat))
    blocks = blocks_for(cohort, adm, pat, src, cfg, train_ids=train_subjects(labels))
    return AS.assemble_features(blocks, labels)


def train_subjects(labels: DataFrame) -> DataFrame:
    """Subjects that are training rows for every target: what is fitted for
    all targets together (word vectors) may see no others."""
    kept = labels.select("subject_id")
    for target in TARGETS:
        split = B.stratified_split(labels.select("subject_id", target), target)
        kept = kept.join(split.where(F.col("split") == "train").select("subject_id"), "subject_id", "left_semi")
    return kept


def save_models(path: str, cfg: Config, bundles: dict) -> None:
    """T6 for a whole run: one bundle for each target and the word vectors."""
    for target, (prep, model, cal) in bundles.items():
        T.save_bundle(f"{path}/{target}", prep, model, cal, {"target": target, "embeddings": cfg.w2v_model is not None})
    if cfg.w2v_model is not None:
        cfg.w2v_model.save(f"{path}/word_vectors")


def load_models(path: str, targets=None) -> tuple[dict, object]:
    """Bundles by target and the word vectors (None if the run had none)."""
    bundles, with_vectors = {}, False
    for target in targets or list(TARGETS):
        prep, model, cal, meta = T.load_bundle(f"{path}/{target}")
        bundles[target] = (prep, model, cal)
        with_vectors |= bool(meta["embeddings"])
    return bundles, WordVectors.load(SparkSession.getActiveSession(), f"{path}/word_vectors") if with_vectors else None


def train_targets(matrix: DataFrame, cfg: Config, targets=None) -> dict:
    """Per target: split, prepare on train, class weight, boosted trees
    with the tuned settings, isotonic calibration on validation."""
    out = {}
    # one written copy of the matrix (spark.checkpoint.dir): every fit
    # statistic below reads it instead of replaying cohort + blocks
    matrix = materialize(matrix)
    for target in targets or list(TARGETS):
        s = stage_packed(B.stratified_split(matrix, target), "split", len(matrix.columns))
        plan = B.discover_columns(s, exclude=list(TARGETS) + ["split"])
        prep = B.fit_preparation(s.where(F.col("split") == "train"), plan)
        x = prep.transform(s, ["subject_id", "split", target])
        x = stage_packed(x, "matrix", len(prep.output_columns))
        spw = B.class_weight(s, target).first()["scale_pos_weight"]
        params = T.BEST_PARAMS[target]
        weight = spw * params["spw_factor"] if cfg.tuned_weight else spw
        model = T.train_classifier(x, target, params, weight, cfg.max_iter, patience=cfg.patience)
        cal = T.calibrate_isotonic(T.positive_probability(model, x.where(F.col("split") == "val")), target)
        out[target] = (prep, model, cal)
    return out


def score_unseen(ids: DataFrame, src: Sources, cfg: Config, bundles: dict) -> DataFrame:
    """Ids -> cohort -> the same blocks -> one probability per target:
    (subject_id, mortality_proba, prolonged_LOS_proba, readmission_proba)."""
    cohort, adm, pat = cohort_for(ids, src)
    feats = materialize(AS.assemble_features(blocks_for(cohort, adm, pat, src, cfg, cfg.w2v_model)))
    out = feats
    for target, (prep, model, cal) in bundles.items():  # one projection after another of the same rows, no joins
        kept = [F.col(f"`{c}`") for c in out.columns]
        out = T.predict(model, cal, prep.transform(out, out.columns), kept).withColumnRenamed("y_pred", TARGETS[target])
    return out.select("subject_id", *[TARGETS[t] for t in bundles])
