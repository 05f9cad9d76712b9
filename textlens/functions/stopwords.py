"""English stop-word list used by the optional stop-word filter."""

from __future__ import annotations

# The stop list must equal the one the original tool ships
# (136 words, in their original order).
STOP_WORDS = (
    'i', 'me', 'my', 'myself', 'we', 'our', 'ours', 'ourselves', 'you', 'your', 'yours', 'yourself',
    'yourselves', 'he', 'him', 'his', 'himself', 'she', 'her', 'hers', 'herself', 'it', 'its', 'itself',
    'they', 'them', 'their', 'theirs', 'themselves', 'what', 'which', 'who', 'whom', 'this', 'that',
    'these', 'those', 'am', 'is', 'are', 'was', 'were', 'be', 'been', 'being', 'have', 'has', 'had',
    'having', 'do', 'does', 'did', 'doing', 'a', 'an', 'the', 'and', 'but', 'if', 'or', 'because', 'as',
    'until', 'while', 'of', 'at', 'by', 'for', 'with', 'about', 'against', 'between', 'into', 'through',
    'during', 'before', 'after', 'above', 'below', 'to', 'from', 'up', 'down', 'in', 'out', 'on', 'off',
    'over', 'under', 'again', 'further', 'then', 'once', 'here', 'there', 'when', 'where', 'why', 'how',
    'all', 'any', 'both', 'each', 'few', 'more', 'most', 'other', 'some', 'such', 'no', 'nor', 'not',
    'only', 'own', 'same', 'so', 'than', 'too', 'very', 's', 't', 'can', 'will', 'just', 'don', 'should',
    'now', 'one', 'two', 'three', 'four', 'five', 'six', 'seven', 'eight', 'nine',
)


def stopwords_df(spark):
    """The stop list as a one-column DataFrame ``(word)``; 136 rows, safe to broadcast."""
    return spark.createDataFrame([(w,) for w in STOP_WORDS], "word string")


def sql_list(words=STOP_WORDS) -> str:
    """The list as a SQL array literal body: ``'i', 'me', ...``."""
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)
