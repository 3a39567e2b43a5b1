"""Stop-word lists.

The lists are the ones Spark ML ships (``StopWordsRemover.loadDefaultStopWords``).
They are read straight from the Spark ML jar so that the Spark plan and the
SQL oracle use the very same words without a running JVM.
"""

from __future__ import annotations

import functools
import glob
import os
import zipfile

# Which stop list a language code selects. Prefixes are tried
# in this order and the first match wins; any other language keeps all words.
STOP_LIST_BY_PREFIX = (
    ("de", "german"),
    ("en", "english"),
)


def _mllib_jar() -> str | None:
    try:
        import pyspark
    except ImportError:  # pragma: no cover
        return None
    pattern = os.path.join(os.path.dirname(pyspark.__file__), "jars", "spark-mllib_*.jar")
    jars = sorted(glob.glob(pattern))
    return jars[0] if jars else None


@functools.lru_cache(maxsize=16)
def load(language: str) -> tuple[str, ...]:
    """Words of one of Spark's default stop lists.

    Read from the jar beside the Python package, else through the running
    session; an absent list is an error, so results do not depend on how
    Spark is installed.
    """
    jar, words = _mllib_jar(), ()
    if jar is not None:
        with zipfile.ZipFile(jar) as archive:
            words = tuple(archive.read(f"org/apache/spark/ml/feature/stopwords/{language}.txt").decode("utf-8").split())
    else:
        from pyspark.ml.feature import StopWordsRemover

        words = tuple(StopWordsRemover.loadDefaultStopWords(language))
    if not words:
        raise RuntimeError(f"the stop list '{language}' is empty or missing")
    return words


def lists_by_prefix() -> list[tuple[str, tuple[str, ...]]]:
    return [(prefix, load(name)) for prefix, name in STOP_LIST_BY_PREFIX]
