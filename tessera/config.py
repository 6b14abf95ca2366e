"""Column roles and constants of the two corpora."""

# Names and label domains of the input files; the order of the classes gives their ids.
TASKS: dict[str, list[str]] = {
    "clickbait_framing_label": ["no", "yes", "uncertain"],
    "chaos_prone_emotion_label": ["no", "yes", "uncertain"],
    "propaganda_pattern_label": ["no", "yes", "uncertain"],
    "market_relevance_label": ["A", "B", "C"],
}
KEY = "article_id"
TITLE, CONTENT = "title", "content_clean"
NOT_FEATURES = ["rationale", "annotator_id", "annotation_status"]
REQUIRED = [KEY, "source", "published_at", TITLE, CONTENT, *NOT_FEATURES, *TASKS]
RAW_TITLE, RAW_CONTENT = "Judul", "Content"
RAW_DROPPED = ["tag1", "tag2", "tag3", "tag4", "tag5", "Link", "Waktu"]
RAW_COLUMNS = [RAW_TITLE, RAW_CONTENT, "source", *RAW_DROPPED]
# What CSV readers of the pandas family take for missing.
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
SEED = 42
MAX_LENGTH = 384
SPECIAL_TOKENS = 3
BATCH_SIZE = 8
ACCUMULATION = 4
EPOCHS = 5
WARMUP = 0.10
PATIENCE = 2
DROPOUT = 0.15
LEARNING_RATE, WEIGHT_DECAY, CLIP = 2e-5, 0.01, 1.0
SPLITS = (("train", 0.8), ("val", 0.1), ("test", 0.1))
