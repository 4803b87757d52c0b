"""Operator 2: URL verdicts by rules, then by logistic regression on hashed character n-grams.

Host and path are cut with column functions. The few rules are a literal condition, so nothing
is joined. URLs without a rule are judged by a classifier trained on a small labelled table of
URLs (a parameter); it has 2 ** BITS weights whatever the input, and scores batches in place.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 14
#: Share of URLs that are taken to be ones to block; the labelled table holds as many of each label.
PRIOR = 0.3
#: Rules: (host, path, verdict); a rule covers the host, its subdomains, and paths that start with the path.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

# The names of the small labelled URL table, hand-written, by label; below, what both labels' names are put together with.
BLOCKED_NAMES = """
casino-bonus best-casino-online royalcasino mycasino-slots casinospin slots-jackpot lucky-slots pokerjackpot free-poker-chips pokerroom
sportsbet247 bet-on-football free-bet-offer livebets bingo-prizes roulette-wheel lottery-winner lotto-jackpot betting-odds-tips gambling-money
cheap-pills-rx pharma-discount viagra-cialis-store buy-pills-online diet-pills-fast steroids-shop
adult-cams-live xxx-tube-videos hot-singles-near sexcams porn-hd-free adult-dating-chat nude-pics escort-girls adult-videos
torrent-warez free-crack-serial warez-games movie-torrents keygen-free cracked-software
win-iphone-prize free-prize-claim you-are-winner gift-card-free claim-your-reward
click-track-ads ads-tracker popup-ads adserver-track track-clicks banner-ads-network
payday-loan-fast instant-cash-loans easy-credit-loan debt-loan-now
crypto-double-btc bitcoin-giveaway free-btc-miner crypto-profit-bot forex-easy-money
seo-backlinks-cheap buy-followers-likes cheap-traffic-seo spam-mailer link-farm-spam replica-watches-sale fake-rolex-cheap replica-handbags
weight-loss-miracle lose-fat-fast malware-update-flash phish-login-verify secure-account-verify update-your-bank-login
""".split()
ALLOWED_NAMES = """
wikipedia python-docs library museum university weather city-hall health journal school archive maps
news newspaper morning-post radio world-news local-times gardeners travel recipes kitchen-notes hiking-trails birdwatch
linux-forum developer code-review python-tips math-lessons physics bookstore furniture bakery music-school theatre
football-club tennis chess-club running riverton stonebridge hanover tinsley eastern lighthouse orchestra ceramics astronomy choir-society embroidery
history-society parliament court hospital clinic-guide railway-timetable airport hotel-lakeside weather-station ocean-science
short-stories northern-lights beekeeping childcare thornton weather-map volunteers knitting southern leather chemistry-notes geology
""".split()
BEFORE = ["", "www.", "m.", "blog."]
ENDINGS = ["example.com", "com", "example.org", "net", "example.net", "org", "top", "co", "info"]
BLOCKED_PATHS = "/ /free-spins/win /slots?ref=1 /play/now /odds/live /buy/cheap /watch/free /join?aff=9 /download/crack.exe /claim/prize /redirect?u=9 /apply/now /about /index.php?id=3 /contact.html /archive/2019/".split()
ALLOWED_PATHS = "/ /wiki/Forest /science/2021/04/river /culture/opera /contact.html /soup/lentil /library/json.html /articles/ecology /about /programme/music /catalog/books /council/minutes?page=2 /archive/2019/ /index.php?id=3".split()


def labelled(names: list[str], paths: list[str], each: int = 4) -> list[str]:
    """The URLs of one label: every name `each` times, with beginnings, endings and paths taken in turn."""
    turns = [(k, j, each * k + j) for k in range(len(names)) for j in range(each)]
    return [BEFORE[(k + j) % len(BEFORE)] + names[k] + "." + ENDINGS[t % len(ENDINGS)] + paths[t % len(paths)] for k, j, t in turns]


BLOCKED, ALLOWED = labelled(BLOCKED_NAMES, BLOCKED_PATHS), labelled(ALLOWED_NAMES, ALLOWED_PATHS)


def host_path(url: F.Column) -> tuple[F.Column, F.Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for a null or where there is no `://`."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring({0}, instr({0}, '://') + 3)".format("url"))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def grams(host: str, path: str) -> np.ndarray:
    """Hashed n-grams of 3 to 5 characters of the host and of the path."""
    out = []
    for kind, part in (("h", f"^{host}$"), ("p", f"{path}$")):
        for n in (3, 4, 5):
            out += [zlib.crc32((kind + part[i : i + n]).encode("utf-8", "replace")) & ((1 << BITS) - 1) for i in range(len(part) - n + 1)]
    return np.unique(np.array(out, np.int64))


def train(blocked: list[str], allowed: list[str], steps: int = 600, ridge: float = 3e-4) -> tuple[np.ndarray, float]:
    """Weights and bias of the logistic regression, from the small table; the bias is set for the share PRIOR."""
    rows = [grams(*_cut(x)) for x in [*blocked, *allowed]]
    y = np.array([1.0] * len(blocked) + [0.0] * len(allowed))
    row = np.repeat(np.arange(len(rows)), [len(x) for x in rows])
    col = np.concatenate(rows)
    each = 1 / np.sqrt(np.array([len(x) for x in rows]))
    w, bias = np.zeros(1 << BITS), 0.0
    for _ in range(steps):
        e = 1 / (1 + np.exp(-(np.bincount(row, w[col], len(rows)) * each + bias))) - y
        w -= 2.0 * (np.bincount(col, (e * each)[row], 1 << BITS) / len(rows) * 10 + ridge * w)
        bias -= 2.0 * e.mean()
    return w, bias + math.log(PRIOR / (1 - PRIOR))


def _cut(url: str) -> tuple[str, str]:
    host, slash, path = url.partition("/")
    return host.lower(), slash + path.partition("?")[0]


def probability(w: np.ndarray, bias: float, host: str, path: str) -> float:
    """Probability that a URL is to be blocked."""
    g = grams(host, path)
    return float(1 / (1 + np.exp(-(w[g].sum() / np.sqrt(max(len(g), 1)) + bias))))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, blocked: list[str] = BLOCKED, allowed: list[str] = ALLOWED) -> DataFrame:
    """page_id, host, path, rule, verdict and score of every row of `pages`.

    The rule with the longest host and path wins; a URL under none is blocked from a
    probability of one half. Null URLs have an empty host and path and are judged like any other;
    repeated rows stay; a null page_id stays null; an empty table gives no rows; extra columns are ignored. A very
    long URL is judged whole, with memory for its n-grams.
    """
    w, bias = train(blocked, allowed)

    @F.pandas_udf("double")
    def judged(host: pd.Series, path: pd.Series) -> pd.Series:
        return pd.Series([probability(w, bias, h, p) for h, p in zip(host, path, strict=True)], dtype=float)

    host, path = host_path(F.col("url"))
    cut = pages.select("page_id", F.col("url").cast("string").alias("url")).select("page_id", host.alias("host"), path.alias("path"))
    rule = verdict = None
    for h, p, v in sorted(rules, key=lambda r: -len(r[0] + r[1])):
        fits = ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
        rule = F.when(fits, h + p) if rule is None else rule.when(fits, h + p)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    scored = cut.withColumn("score", judged.asNondeterministic()("host", "path"))
    learned = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    if rule is None:
        return scored.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), learned.alias("verdict"), "score")
    return scored.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, learned).alias("verdict"), "score")
