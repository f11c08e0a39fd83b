"""Fixed values shared by the layers."""

# --- fixed values: they decide results and must stay as they are -------------

# Label words, after lower-casing and stripping.
CREDIBLE_LABELS = ["true", "mostly-true", "half-true", "real"]
MISINFORMATION_LABELS = ["false", "pants-fire", "barely-true", "fake"]
CREDIBLE, MISINFORMATION, UNKNOWN = 0, 1, -1
CLASS_NAMES = {CREDIBLE: "credible", MISINFORMATION: "misinformation"}

# Source names and the credibility attached to each.
STATEMENT_SOURCE = "liar"
HEADLINE_SOURCE = "fakenewsnet"
POST_SOURCE = "bluesky"
SOURCE_CREDIBILITY = {"liar": 0.7, "fakenewsnet": 0.6, "bluesky": 0.3}
DEFAULT_CREDIBILITY = 0.5

# Search terms of the post source.
SEARCH_TERMS = ["news", "politics", "misinformation", "fact check"]

# Text patterns.
TAG_PATTERN = "<[^>]+>"
SPACE_PATTERN = r"\s+"

# Ten hash buckets: 0..7 train, 8 val, 9 test.
SPLIT_BUCKETS = 10
TRAIN, VAL, TEST = "train", "val", "test"

# Row key of every layer.
KEYS = ["id", "source"]

# Lengths accepted for scoring, in characters.
MIN_TEXT_CHARS, MAX_TEXT_CHARS = 10, 2000

# Quality gate.
MIN_F1 = 0.80
MIN_TRAIN_ROWS = 5000
