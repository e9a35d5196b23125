"""A small labelled table of urls for the url filter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Words of kinds of sites that are usually not wanted, and of ordinary ones. No name of a site is among them; sites are
# made by pairing the words in turn.
UNWANTED_KINDS = (
    "casino", "poker", "slots", "roulette", "betting", "bets", "jackpot", "pills", "pharma", "meds", "viagra", "adult", "porn", "xxx",
    "sexcams", "escort", "spam", "malware", "warez", "cracks", "torrent", "ads", "adserver", "tracker", "popups", "clickbait",
)
UNWANTED_OFFERS = ("bonus", "online", "deals", "free", "hot", "cheap", "now", "zone", "live", "best")
ORDINARY_KINDS = (
    "library", "garden", "museum", "weather", "news", "school", "science", "recipes", "history", "forum", "travel", "football",
    "health", "theatre", "nature", "music", "radio", "physics", "kitchen", "letters", "village", "river", "painting", "chess", "bakery", "language",
)
ORDINARY_PLACES = ("city", "old", "public", "north", "open", "daily", "little", "county", "green", "home")


def _sites(kinds: tuple[str, ...], others: tuple[str, ...], paired: int) -> tuple[str, ...]:
    """Every kind alone, and before and behind so many of the other words."""
    names = list(kinds)
    for i, kind in enumerate(kinds):
        for k in range(paired):
            names += [f"{kind}-{others[(i + k) % len(others)]}", f"{others[(3 * i + k + 1) % len(others)]}-{kind}"]
    return tuple(names)


# There are more ordinary sites, so what is like neither is allowed.
UNWANTED = _sites(UNWANTED_KINDS, UNWANTED_OFFERS, 1)
ORDINARY = _sites(ORDINARY_KINDS, ORDINARY_PLACES, 2)
PREFIXES = ("", "www.", "m.", "blog.")
ENDINGS = ("example.com", "example.net", "example.org")
PATHS = ("/en/12", "/de/345.html", "/fr/6789/", "/es/40?page=2", "/en/77#top", "/")


def labelled_urls(spark: SparkSession) -> DataFrame:
    """(url, blocked): every site once with each ending, under varying prefixes and paths."""
    rows = []
    for blocked, sites in ((1, UNWANTED), (0, ORDINARY)):
        for i, site in enumerate(sites):
            for j, ending in enumerate(ENDINGS):
                for k in range(2):
                    prefix, path = PREFIXES[(i + j + 2 * k) % len(PREFIXES)], PATHS[(i + 2 * j + 3 * k) % len(PATHS)]
                    rows.append((f"https://{prefix}{site}.{ending}{path}", blocked))
    return spark.createDataFrame(rows, "url string, blocked int")
