"""URL filters: pattern rules indexed by their rarest literal token.

Every rule has literal tokens that a matching URL must hold; it is filed under the one that is rarest among the URLs of
the table. The tokens of a URL fetch its candidate rules, and only those run their regular expressions. The rule with the
longest name wins, ties go to the first by name. Null URLs and such without `://` have an empty host and path, no rule,
and are allowed. Repeated rows are judged row by row.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rules that one pass carries to its tasks; further rules take further passes.
RULES_A_PASS = 20_000
TOKEN = r"[0-9A-Za-z]+"


@dataclass(frozen=True)
class Rule:
    """name is shown; tokens must all be in the URL's tokens (lower case); pattern is searched in `host + path`."""

    name: str
    verdict: str
    tokens: tuple[str, ...]
    pattern: str
    listed: bool = False


def site_rule(verdict: str, name: str) -> Rule:
    """A rule for a host, its subdomains and the paths that start alike, like `example.net/en/`."""
    host, path = name.split("/", 1)
    tokens = tuple(t.lower() for t in re.findall(TOKEN, host))
    # The path's last token may go on in the URL, unless a slash ends it.
    whole = re.findall(rf"(?<![0-9A-Za-z]){TOKEN}(?![0-9A-Za-z]|$)", "/" + path)
    pattern = rf"\A(?:[^/]*\.)?{re.escape(host)}/{re.escape(path)}"
    return Rule(name, verdict, tokens + tuple(t.lower() for t in whole), pattern, True)


def word_rules(words: str, place: str = "") -> list[Rule]:
    """A blocking rule for each word, or words in this order joined by `+`, as whole tokens behind what `place` allows."""
    return [
        Rule(name, "block", tuple(name.split("+")), rf"(?i){place}(?<![0-9a-z]){name.replace('+', '[^0-9a-z/]?')}(?![0-9a-z])")
        for name in words.split()
    ]


#: Words of several meanings count in the host only.
IN_HOST = r"\A[^/]*"
#: Beyond the listed sites: words of unwanted kinds in a host's name or path. `casinos` is left out.
PATTERNS = tuple(
    # gambling
    word_rules(
        "casino bet bets betting bettor bettors gamble gambler gamblers gambling jackpot jackpots bookie bookies bookmaker "
        "bookmakers roulette sportsbook sportsbooks blackjack baccarat wager wagers wagering slot+machine slot+machines"
    )
    + word_rules("poker slots lottery lotto bingo", IN_HOST)
    # adult
    + word_rules(
        "porn porno pornos pornography pornographic xxx xxxx erotic erotica hentai milf milfs nude nudes camgirl camgirls hookup "
        "hookups escort+service escort+services sex+cam sex+cams sex+chat sex+video sex+videos"
    )
    + word_rules("adult adults sex sexy escort escorts naked", IN_HOST)
    # pharmacy
    + word_rules(
        "viagra cialis levitra tramadol xanax valium phentermine pill pills buy+meds cheap+meds online+pharmacy "
        "online+pharmacies cheap+drugs"
    )
    + word_rules("meds pharmacy pharmacies", IN_HOST)
    # spam
    + word_rules(
        "spam spams spammer spammers spammy spamming phishing malware warez torrent torrents keygen keygens replica+watches "
        "fake+watches payday+loan payday+loans link+farm link+farms get+rich+quick work+from+home+cash"
    )
    # advertising and tracking
    + word_rules(
        "ads advert adverts adserver adservers adserve adservice adtech adclick adclicks doubleclick popunder popunders popup+ads "
        "clickbait banner+ad banner+ads ad+server ad+servers track+click track+clicks click+tracker click+tracking "
        "tracking+pixel tracking+pixels web+beacon web+beacons"
    )
    + word_rules("ad tracker trackers tracking advertising", IN_HOST)
)


def parsed(pages: DataFrame) -> DataFrame:
    host = F.translate(
        F.regexp_extract("url", r"(?s)\A.*?://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    )
    path = F.regexp_extract("url", r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)
    return pages.select("page_id", F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))


def token_counts(urls: DataFrame, tokens: set[str]) -> dict[str, int]:
    """Number of URLs' tokens equal to each of the rules' tokens; as many rows as the rules have tokens."""
    words = urls.select(
        F.explode(F.regexp_extract_all(F.lower(F.concat("host", "path")), F.lit(r"([0-9a-z]+)"), F.lit(1))).alias("token")
    )
    rows = words.where(F.col("token").isin(sorted(tokens))).groupBy("token").count().collect()
    return {t: 0 for t in tokens} | {r["token"]: r["count"] for r in rows}


def index_rules(rules: list[Rule], counts: dict[str, int]) -> dict[str, list[Rule]]:
    index: dict[str, list[Rule]] = {}
    for rule in rules:
        index.setdefault(min(rule.tokens, key=lambda t: (counts[t], t)), []).append(rule)
    return index


def matcher(index: dict[str, list[Rule]]):
    @F.pandas_udf("struct<size:int,name:string,verdict:string,listed:boolean>")
    def match(hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        found = []
        for host, path in zip(hosts, paths, strict=True):
            place = host + path
            fits = {
                rule
                for token in set(re.findall(TOKEN, place.lower()))
                for rule in index.get(token, ())
                if re.search(rule.pattern, place)
            }
            best = min(fits, key=lambda r: (not r.listed, -len(r.name), r.name), default=None)
            found.append((len(best.name), best.name, best.verdict, best.listed) if best else (None,) * 4)
        return pd.DataFrame(found, columns=["size", "name", "verdict", "listed"])

    return match


def url_filter(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """page_id, host, path, the listed rule that fits best, and the verdict."""
    urls = parsed(pages)
    out = urls.withColumn("best", F.lit(None).cast("struct<size:int,name:string,verdict:string,listed:boolean>"))
    for start in range(0, len(rules), RULES_A_PASS):
        part = rules[start : start + RULES_A_PASS]
        index = index_rules(part, token_counts(urls, {t for r in part for t in r.tokens}))

        match = matcher(index)
        new = match("host", "path")
        old = F.col("best")
        better = old["name"].isNull() | (
            new["name"].isNotNull()
            & ((new["listed"] & ~old["listed"]) | ((new["listed"] == old["listed"]) & (new["size"] > old["size"])))
        )
        out = out.withColumn("best", F.when(better, new).otherwise(old))
    return out.select(
        "page_id",
        "host",
        "path",
        F.when(F.col("best.listed"), F.col("best.name")).alias("rule"),
        F.coalesce("best.verdict", F.lit("allow")).alias("verdict"),
    )
