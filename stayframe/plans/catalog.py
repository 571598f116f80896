"""Import every query module so the registry is complete."""

from stayframe.plans import q_clean_intervals, q_cohort, q_eval_compare, q_io, q_model, q_text_demo, q_timeseries  # noqa: F401
from stayframe.plans.registry import QUERIES  # noqa: F401
