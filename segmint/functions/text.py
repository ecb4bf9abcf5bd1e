"""Text helpers shared by the Spark operators and their SQL twins."""

from __future__ import annotations

from .stopwords import ENGLISH

# The characters Java's regex ``\s`` matches (what the ML
# Tokenizer splits on), written out so every engine splits identically:
# space, tab, newline, vertical tab, form feed, carriage return.
WHITESPACE = "[ \\t\\n\\x0B\\f\\r]"


def stop_words(language: str = "english") -> tuple[str, ...]:
    """Spark ML's default stop-word list for ``language``. English, the only
    language the registered queries use, is a literal list (``stopwords.py``)
    and needs neither a session nor a JVM; any other language is asked of
    ``StopWordsRemover``, which needs a running session."""
    if language == "english":
        return ENGLISH
    from pyspark.ml.feature import StopWordsRemover
    return tuple(StopWordsRemover.loadDefaultStopWords(language))
