"""URL filter: host and path rules, and a logistic regression for all other URLs.

The classifier sees hashed character n-grams of the host and of the path; host and
path n-grams are kept apart.  It is trained from a small table of labelled URLs.
Rules go first: a rule holds for its host and all subdomains where the path of the
URL starts with its own, and the longest rule wins.

A URL without ``://`` (or null) has an empty host and path; no rule fits, and it is allowed,
as the empty URL is one of the wanted ones in training.  Labelled URLs are cut as the judged
ones are (without query and fragment), and both classes weigh the same however many URLs
they have.  Rows that repeat are judged one by one.  A URL is read whole, however long.  An
empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clamor.llm.common import fresh
from clamor.llm.ngrams import code_points, hashed

BITS = 13  # of an n-gram's hash; the weights take 2 ** (BITS + 1) numbers
SIZES = (3, 4, 5)
RIDGE = 0.02
STEPS = 400

# Rule (host and path) and verdict.
RULES = [
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
]

# The labelled URLs, as host and path: unwanted ones, then wanted ones.
UNWANTED = """
casino-royal.test/bonus
www.best-casino.test/slots/free-spins
online-casino.test/en/jackpot
poker-stars-win.test/play
bet-now.test/odds/football
sportsbetting.test/live-bet
win-big-money.test/claim
lottery-winner.test/claim-prize
free-slots.test/spin
cheap-pills.test/viagra
pharmacy-discount.test/buy/cialis
rx-meds.test/no-prescription
adult-video.test/xxx
hot-sex-chat.test/live
xxx-tube.test/porn
free-porn.test/video/1
escort-girls.test/city
dating-hot-singles.test/join
payday-loans.test/apply
quick-loan-cash.test/now
crypto-doubler.test/giveaway
bitcoin-profit.test/earn-money
earn-money-fast.test/work-from-home
free-iphone-prize.test/survey
click-bait-news.test/you-wont-believe
warez-crack.test/keygen
torrent-free-download.test/movie
download-crack.test/serial-key
replica-watches.test/shop
fake-bags.test/outlet
spam-links.test/seo-backlinks
buy-followers.test/cheap
win-prizes.test/casino
blog.casino-bet.test/review
malware-update.test/flash-player.exe
phishing-login.test/verify-account
ads.tracker.test/pixel.gif
m.ads-server.test/banner/click
track-clicks.test/ad/impression
adult-content.test/gallery
www.spam-mails.test/unsubscribe
link-farm.test/seo/spam
cheap-meds.test/pills
free-bets.test/bonus/today
vip-casino.test/free-bonus
casino-jackpot.test/slots/win
mega-slots.test/casino/play-now
poker-room.test/free-chips
texas-poker.test/bonus
football-bets.test/free-odds
sports-bet.test/bonus/odds
claim-your-prize.test/win
win-a-prize.test/free-iphone
big-lottery.test/win-money
generic-viagra.test/cheap
discount-pills.test/pharmacy
cialis-pharmacy.test/pills
adult-tube.test/free-porn
sex-cams.test/adult/live
free-xxx.test/adult
hot-dating.test/sex/chat
singles-sex.test/dating
cash-loans.test/payday/quick
instant-loans.test/cash/apply-now
torrent-movies.test/free-download
free-torrent.test/crack
keygen-serial.test/crack/download
crack-warez.test/free
banner-ads.test/click
ads-network.test/track/pixel
ad-tracker.test/impression
spam-farm-links.test/backlinks
seo-spam.test/cheap/backlinks
earn-cash.test/free-money
fast-money.test/earn/bitcoin
cheap-replica.test/watches/buy
malware-exe.test/download/free.exe
phishing-bank.test/login/verify
""".split()
WANTED = """
en.encyclopedia.test/wiki/history
docs.library.test/reference/functions
blog.gardener.test/2021/05/tomatoes
news.daily.test/politics/election
www.university.test/research/physics
m.weather.test/forecast/today
www.recipes.test/bread
forum.cyclists.test/thread/1234
shop.books.test/novel/55
museum.test/exhibitions
city-council.test/minutes/2020.html
blog.teacher.test/lessons/8
www.hospital.test/patients/visiting
developer.cloud.test/guide/install
journal.medicine.test/article/991
travel.mountains.test/de/routes
kids.school.test/fr/calendar
www.orchestra.test/concerts
archive.newspaper.test/1999/12/31
m.transport.test/timetable
parliament.test/bills/77.html
astronomy.club.test/es/observations
wiki.language.test/grammar
history.test/articles/vikings
blog.painter.test/gallery/
stories.test/fairy-tales.html
poems.test/collection/spring
www.farmers.test/market
science.test/questions/gravity
music.band.test/tour
church.test/services
open.data.test/tables/12
chess.club.test/games
math.test/notes/algebra
www.farm-holidays.test/rooms
trains.test/track/repairs
adventure.club.test/trips
freedom-of-press.test/report
beta.software.test/release-notes
en.encyclopedia.test/wiki/river
wiki.history.test/article/roman-empire
docs.cloud.test/reference/api
developer.library.test/guide/start
blog.science.test/2020/11/stars
blog.traveller.test/notes/alps
news.world.test/article/2021/03/04
www.newspaper.test/politics/city
m.news.test/science/climate
university.test/lectures/mathematics
school.city.test/teachers.html
library.university.test/catalogue
m.recipes.test/soup
forum.gardeners.test/thread/88
forum.developers.test/topic/install
museum.history.test/exhibitions/2020
hospital.city.test/visiting/hours
journal.physics.test/article/17
www.theatre.test/calendar/
thoughts.test/essays/memory
m.theory.test/music/harmony
blog.neighbours.test/garden/
www.rhetoric.test/speeches.html
translations.test/poetry/index
another.test/about
books.test/novel/chapter/3
music.school.test/lessons
weather.city.test/forecast
trains.city.test/timetable
farmers.market.test/en/opening
cooking.family.test/soup
river.walks.test/map
""".split()


def host_of(url: Column) -> Column:
    after = F.when(
        F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url))
    ).otherwise("")
    host = F.regexp_extract(after, r"^[^/?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    after = F.when(
        F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url))
    ).otherwise("")
    return F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as host + path; else null."""
    found = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(
            path, F.lit(slash + rest)
        )
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def features(host: str, path: str) -> np.ndarray:
    """Places of all n-grams; those of a path lie above those of a host."""
    found = []
    for part, text in enumerate((host, path)):
        codes = code_points(f"^{text}$") if text else np.empty(0, np.uint32)
        found += [hashed(codes, n, BITS) + (part << BITS) for n in SIZES]
    return np.concatenate(found)


def row_vector(host: str, path: str) -> np.ndarray:
    """Which n-grams occur, scaled to length 1."""
    vector = np.zeros(2 << BITS)
    vector[features(host, path)] = 1
    return vector / max(1.0, np.sqrt(vector.sum()))


def parts(labelled: str) -> tuple[str, str]:
    """Host and path of a labelled URL, cut as ``host_of`` and ``path_of`` do."""
    host, path = re.match(r"([^/?#]*)([^?#]*)", labelled).groups()
    return host.lower(), path


def train(unwanted=tuple(UNWANTED), wanted=tuple(WANTED)) -> np.ndarray:
    """Weights, the bias last, by accelerated gradient descent on the whole table.

    The labelled table is small by contract: it is written out above.  The empty URL is
    added to the wanted ones.
    """
    wanted = (*wanted, "")
    x = np.stack([row_vector(*parts(u)) for u in (*unwanted, *wanted)])
    seen = np.append(np.flatnonzero(x.any(axis=0)), x.shape[1])
    x = np.hstack([x, np.ones((len(x), 1))])[:, seen]
    y = np.array([1.0] * len(unwanted) + [0.0] * len(wanted))
    share = np.where(y == 1, 0.5 / len(unwanted), 0.5 / len(wanted))
    w, ahead = np.zeros(x.shape[1]), np.zeros(x.shape[1])
    ridge = np.append(np.full(x.shape[1] - 1, RIDGE / len(x)), 0.0)
    for step in range(STEPS):
        gradient = x.T @ (share * (1 / (1 + np.exp(-x @ ahead)) - y)) + ridge * ahead
        new = ahead - 2 * gradient
        ahead, w = new + step / (step + 3) * (new - w), new
    weights = np.zeros((2 << BITS) + 1)
    weights[seen] = w
    return weights


def url_verdicts(pages: DataFrame, url: str = "url", rules=RULES) -> DataFrame:
    """The rows of pages with host, path, rule, verdict and spam (the classifier's
    probability).  Columns of pages with such a name stay; the new ones get an
    underscore then."""
    weights = train()
    host, path, rule, verdict, spam = fresh(pages, "host", "path", "rule", "verdict", "spam")

    @F.pandas_udf("double")
    def judged(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for hosts, paths in batches:
            margins = []
            for h, p in zip(hosts, paths, strict=True):
                places = np.unique(features(h, p))
                margins.append(
                    weights[places].sum() / max(1.0, np.sqrt(len(places))) + weights[-1]
                )
            yield pd.Series(1 / (1 + np.exp(-np.array(margins, dtype=float))))

    split = pages.withColumns(
        {
            host: F.coalesce(host_of(F.col(url)), F.lit("")),
            path: F.coalesce(path_of(F.col(url)), F.lit("")),
        }
    ).withColumn(spam, judged(host, path))
    by_rule = F.lit(None).cast("string")
    for name, said in rules:
        by_rule = F.when(F.col(rule) == name, F.lit(said)).otherwise(by_rule)
    by_model = F.when(F.col(spam) >= 0.5, "block").otherwise("allow")
    return split.withColumn(rule, rule_of(F.col(host), F.col(path), rules)).withColumn(
        verdict, F.coalesce(by_rule, by_model)
    )
