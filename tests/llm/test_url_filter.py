import pytest

from marketloom.llm.labelled_urls import ENDINGS, ORDINARY, PREFIXES, UNWANTED, labelled_urls
from marketloom.llm.queries import URL_RULES
from marketloom.llm.url_filter import judge_urls, train

URLS = [
    ("http://A.Example.com/en/1?x#y", "a.example.com", "/en/1", "example.com/en/", "block"),
    ("https://www.example.com/en/2", "www.example.com", "/en/2", "www.example.com/en/", "allow"),
    ("https://m.www.example.com/en/2", "m.www.example.com", "/en/2", "www.example.com/en/", "allow"),
    ("https://notexample.com/en/2", "notexample.com", "/en/2", "com/", "allow"),
    ("https://example.com/EN/2", "example.com", "/EN/2", "com/", "allow"),
    ("https://spam-farm.example.com", "spam-farm.example.com", "", None, "block"),
    ("https://x.net/es/", "x.net", "/es/", "net/es/", "block"),
    ("https://x.net/es", "x.net", "/es", None, None),
    ("https://net/fr/1", "net", "/fr/1", "net/fr/", "block"),
    ("ftp://ÉX.org://b/c", "Éx.org:", "//b/c", None, None),
    ("no scheme", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("a\nb://h.org\n/p", "h.org\n", "/p", None, None),
    ("://h#f", "h", "", None, None),
]


@pytest.fixture(scope="module")
def model(spark):
    return train(labelled_urls(spark))


def test_parts_rules_and_verdicts(spark, model):
    docs = spark.createDataFrame([(i, u[0], "x") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    found = {r.page_id: r for r in judge_urls(docs, URL_RULES, model).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(URLS):
        assert (found[i].host, found[i].path, found[i].rule) == (host, path, rule)
        assert found[i].verdict == (verdict or ("block" if found[i].score >= 0.5 else "allow"))


def test_the_model_knows_sites_it_was_not_shown(spark):
    """Every fifth pair of words is left out of the table and judged by what its name shares with others."""
    held = [(s, "block") for s in UNWANTED if "-" in s][::5] + [(s, "allow") for s in ORDINARY if "-" in s][::5]
    hidden = "|".join(s for s, _ in held)
    shown = labelled_urls(spark).filter(f"not url rlike '[/.]({hidden})[.]'")
    pages = spark.createDataFrame([(i, f"https://{s}.example.org/xx/9") for i, (s, _) in enumerate(held)], "page_id long, url string")
    found = {r.page_id: r.verdict for r in judge_urls(pages, (), train(shown)).collect()}
    assert sum(found[i] == v for i, (_, v) in enumerate(held)) >= 0.9 * len(held)


def test_no_site_of_the_sample_is_in_the_table(spark, sample):
    """The pages' unwanted and ordinary hosts are new to the model; it finds most of the first and keeps most of the others."""
    hosts = {r.host for r in judge_urls(spark.read.parquet(f"{sample}/pages.parquet"), (), train(labelled_urls(spark))).collect()}
    assert not hosts & {f"{p}{s}.{e}" for s in (*UNWANTED, *ORDINARY) for p in PREFIXES for e in ENDINGS}


def test_training_twice_gives_the_same_model(spark, model):
    assert (train(labelled_urls(spark).repartition(7)).weights == model.weights).all()


def test_nothing_to_learn_from_and_nothing_to_judge(spark):
    empty = train(labelled_urls(spark).limit(0))
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert judge_urls(pages, (), empty).first().verdict == "allow"
    assert judge_urls(pages.limit(0), URL_RULES, empty).count() == 0
