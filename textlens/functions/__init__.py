from textlens.functions.stopwords import STOP_WORDS, stopwords_df  # noqa: F401
from textlens.functions.text import (  # noqa: F401
    PUNCTUATION,
    WHITESPACE_JAVA,
    WHITESPACE_RE2,
    accuracy_text,
    clean_words,
    numbered_word,
    rebuild_text,
    resolve_stopwords,
    sample_id_from_label,
    sample_label,
    word_slice,
    word_with_count,
    zero_fix_text,
    zero_fix_value,
)
