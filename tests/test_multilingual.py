import pytest

from lexigrid.operators.multilingual import LanguageFields
from lexigrid.operators.postings import save_index
from lexigrid.session import shared_folder

TEXTS = [
    (1, "The runners were running quickly", "en"), (2, "Die Häuser der Stadt", "de"), (3, "Das Haus", "de"),
    (4, "hundarna och katten", "sv"), (5, "running in Turkish text", "tr"), (6, "the running text", None),
    (7, None, "en"), (8, "", "de"), (9, "die hard", "en"),
]


@pytest.fixture(scope="module", params=["analysed", "saved"])
def searched(spark, request):
    docs = spark.createDataFrame(TEXTS, "id long, text string, lang string")
    fields = LanguageFields(["en", "de", "sv"])
    corpus = fields.analyze(docs, "id", "text", "lang")
    if request.param == "saved":
        path = shared_folder(spark, "languages")
        save_index(corpus, path)
        corpus = fields.load(docs, "id", path)
    return fields, corpus


def test_the_language_picks_field_and_stems(searched):
    fields, corpus = searched
    asked = {
        "en": ("runs", "en"), "de": ("Hauses", "de"), "sv": ("hunden", "sv"), "tr": ("running the", "tr"),
        "none": ("RUNNING", None), "stop words": ("der die", "de"), "not a stop word": ("die", "en"), "empty": ("", "en"),
    }
    found = {name: set() for name in asked}
    for row in fields.search(corpus, asked).collect():
        found[row.query_id].add(row.key)
        assert row.score > 0
    assert found == {
        "en": {1}, "de": {2, 3}, "sv": {4}, "tr": {5, 6}, "none": {5, 6}, "stop words": set(),
        "not a stop word": {9}, "empty": set(),
    }


def test_each_text_is_in_one_field(searched):
    _, corpus = searched
    by_key = corpus.occurrences.select("key", "field").distinct().groupBy("key").count()
    assert {r["count"] for r in by_key.collect()} == {1}
    lengths = {r.key: r.asDict() for r in corpus.lengths.collect()}
    assert len(lengths) == len(TEXTS)
    assert [lengths[1][f"content_{x}"] for x in ("en", "de", "sv", "other")] == [4, 0, 0, 0]
    assert sum(v for k, v in lengths[7].items() if k != "key") == 0


def test_languages_without_rules_are_an_error():
    with pytest.raises(ValueError):
        LanguageFields(["en", "tr"])
    assert LanguageFields(["en", "tr"], stem=False).names() == ["content_en", "content_tr", "content_other"]
