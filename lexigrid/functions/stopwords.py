"""Stop word lists by language."""

from __future__ import annotations

import glob
import os
import zipfile
from functools import lru_cache

import pyspark

# The English list of the search library.
ENGLISH = (
    "a an and are as at be but by for if in into is it no not of on or such that the "
    "their then there these they this to was will with"
).split()

# ISO codes and names of the supported languages.
LANGUAGES = {
    "ar": "arabic", "da": "danish", "nl": "dutch", "en": "english", "fi": "finnish",
    "fr": "french", "de": "german", "el": "greek", "hu": "hungarian", "it": "italian",
    "no": "norwegian", "pt": "portuguese", "ro": "romanian", "ru": "russian",
    "es": "spanish", "sv": "swedish", "ta": "tamil", "tr": "turkish",
}


def language_name(language: str) -> str:
    """Full name from a name or an ISO code."""
    name = language.strip().lower()
    name = LANGUAGES.get(name, name)
    if name not in LANGUAGES.values():
        raise ValueError(f"unsupported language: {language}")
    return name


@lru_cache(maxsize=None)
def stop_words(language: str) -> tuple[str, ...]:
    """Words to drop for a language; a language Spark ships no list for has none.

    Lists other than English are the Snowball lists that Spark ML ships for its own
    StopWordsRemover, read from the installed jar so that no session is needed.
    """
    name = language_name(language)
    if name == "english":
        return tuple(ENGLISH)
    home = os.environ.get("SPARK_HOME") or os.path.dirname(pyspark.__file__)
    for jar in glob.glob(os.path.join(home, "jars", "spark-mllib_*.jar")):
        with zipfile.ZipFile(jar) as archive:
            member = f"org/apache/spark/ml/feature/stopwords/{name}.txt"
            if member in archive.namelist():
                lines = archive.read(member).decode("utf-8").splitlines()
                return tuple(sorted({line.strip().lower() for line in lines if line.strip()}))
    return ()
