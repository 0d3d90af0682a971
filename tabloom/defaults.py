"""Default limits and lists. All can be overridden by arguments."""

from __future__ import annotations

# --- fixed values that decide results -------------------------------------

# text read as "missing" by the CSV reader, before types are inferred
CSV_NA_VALUES = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]
# text turned into null by the cleaner, after trimming
MISSING_MARKERS = ["?", "", "NA", "NaN"]
# parts of column names that mark identifiers: feature preparation
ID_NAME_PARTS = ["passengerid", "name", "ticket", "cabin"]
# parts of column names that mark identifiers: table comparison
COMPARE_ID_NAME_PARTS = ["id", "ticket", "name", "cabin", "passengerid"]
# a column is ID-like when distinct / rows exceeds this
ID_UNIQUENESS = 0.9

TARGET = "survived"
TEST_SIZE = 0.2
SEED = 42
MIN_ROWS = 10
MIN_CORRELATION_ROWS = 30
MAX_NULL_FRACTION = 0.5
STRONG_CORRELATION = 0.5
VERY_STRONG_CORRELATION = 0.7
MAX_CATEGORIES = 30
NUMERIC_DRIFT = 0.3
CATEGORICAL_DRIFT = 0.2
HISTOGRAM_BINS = 30
BALANCED_RATIO = 1.1
EPSILON = 1e-8

SYNTHETIC_ROWS = 1000
EPOCHS = 1400
BATCH_SIZE = 64
LATENT_DIM = 100
HIDDEN = 128
LEARNING_RATE = 2e-4

# --- limits that keep driver and broadcast data small ----------------------

# classes whose numbers pass through the driver and are broadcast; beyond that they stay tables
DRIVER_CLASSES = 10_000
# classes of a target that a model is fitted for; every per-class parameter table has at most this many rows
MAX_CLASSES = 10_000
# distinct values of one text column whose codes may be broadcast
BROADCAST_VALUES = 20_000
# bytes of such a broadcast
BROADCAST_BYTES = 16 * 1024 * 1024
# columns one text column may become
MAX_ONE_HOT = 1_000
