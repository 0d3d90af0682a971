"""Cleaning, profiling, balancing, synthesis and comparison of tables on Spark."""

from tabloom.errors import ValidationError
from tabloom.operators.checks import check_report, quality_report
from tabloom.operators.cleaning import clean, cleaning_report, impute
from tabloom.operators.comparison import comparison_table, fidelity_score
from tabloom.operators.correlation import correlation_matrix, correlation_report
from tabloom.operators.encoding import label_encode, one_hot
from tabloom.operators.features import prepare_features
from tabloom.operators.sampling import bootstrap_labels, stratified_split, undersample
from tabloom.operators.scaling import fit_min_max, fit_standard
from tabloom.operators.synthesis import SynthModel, continue_fit, fit, sample, synthesize
from tabloom.operators.two_sample import two_sample_tests
from tabloom.plans.full_run import Run, run
from tabloom.sources import read_csv, read_json, read_table, write_report, write_table

__all__ = [
    "Run", "SynthModel", "ValidationError", "bootstrap_labels", "check_report", "clean", "cleaning_report",
    "comparison_table", "continue_fit", "correlation_matrix", "correlation_report", "fidelity_score", "fit",
    "fit_min_max", "fit_standard", "impute", "label_encode", "one_hot", "prepare_features", "quality_report",
    "read_csv", "read_json", "read_table", "run", "sample", "stratified_split", "synthesize",
    "two_sample_tests", "undersample", "write_report", "write_table",
]
