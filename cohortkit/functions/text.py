"""Tokenizing helpers for text features."""

from __future__ import annotations

import functools
import glob
import os
import zipfile

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words of two or more letters, digits or underscores; the same class is
# written identically for Java's and RE2's regex engines.
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"


def tokens(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(TOKEN_PATTERN), 0)


@functools.lru_cache(maxsize=None)
def english_stop_words() -> tuple[str, ...]:
    """Spark ML's default English stop-word list (``StopWordsRemover``),
    read from the Spark ML jar so no JVM is needed."""
    import pyspark
    jars = glob.glob(os.path.join(os.path.dirname(pyspark.__file__), "jars", "spark-mllib_*.jar"))
    if jars:
        with zipfile.ZipFile(jars[0]) as z:
            return tuple(z.read("org/apache/spark/ml/feature/stopwords/english.txt").decode("utf-8").split())
    from pyspark.ml.feature import StopWordsRemover
    return tuple(StopWordsRemover.loadDefaultStopWords("english"))
