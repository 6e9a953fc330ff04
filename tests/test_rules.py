import re

import pytest
from pyspark.sql import functions as F

from tidewright.functions import rules

TABLES = {
    "long": (rules.LONG_FORM_RULES, rules.LONG_FORM_DEFAULT),
    "short": (rules.SHORT_RULES, rules.SHORT_DEFAULT),
    "live": (rules.LIVE_RULES, rules.LIVE_DEFAULT),
    "upper": (rules.UPPER_RULES, rules.UPPER_DEFAULT),
}

TITLES = [
    "[SKZ-TALKER GO! Season 2] Ep.01", "skz-talker ep 3", "슼즈토커 12화", "[SKZ CODE] Ep.50", "[skz code] lower case tag",
    "Two Kids' Song", "Kids Room 3", "kid　ROOM", "[SKZ VLOG] day", "[RACHA LOG]", "SKZ-RECORD ballad", "[SONG by] me",
    "제 9구역 Ep", "the 9TH area", "[SPOT KIDS] x", "m/v reaction", "making film", "Guide video", "Lyric Visualizer", "plain title",
    "Challenge　w/ friends", "Challenge  W/ x", "챌린지 w/ y", "Behind-The-Scenes", "#SKZCODE", "스키즈코드", "#SKZ_TALKER_GO",
    "dominATE tour", "late night", "skz_5clock", "SONGby x", "Cover By y", "Happy생일Day", "HappyDay", "happy\nday", "Happy Day",
    "合 album", "hop hop", "ULTRA", "Do_it now", "신선놀음", "chkchkboom", "LMB_challenge", "樂", "락 page", "5_star", "특", "CASE143",
    "치즈챌린지", "찬이의 '방'", "찬이의 방", "찬이의\n방", "리노리방", "생일 축하", "monday", "데이 6", "COUNTDOWN", "라이브　스트림",
    "라이브스트림", "팬미팅", "song M/V", "song M/V\n", "song M/V \n", "M/V x", "music video", "straße vlog", "2 kids room", "", "\n",
    "bırthday", "bİrthday", "ſkz-talker", "SKZCODE",
]


def expected(title, table, default):
    for pattern, label in table:
        if re.search(pattern, title):
            return label
    return default


@pytest.fixture(scope="module")
def labelled(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TITLES)], "i int, title string")
    columns = [rules.first_match(F.col("title"), t, d).alias(name) for name, (t, d) in TABLES.items() if name != "upper"]
    return df.select("i", *columns, rules.title_category(F.col("title")).alias("upper")).orderBy("i").collect()


@pytest.mark.parametrize("name", list(TABLES))
def test_rules_read_like_unicode_regexes(labelled, name):
    table, default = TABLES[name]
    for row in labelled:
        title = TITLES[row["i"]]
        subject = title.upper() if name == "upper" else title
        assert row[name] == expected(subject, table, default), title


@pytest.mark.parametrize("name", list(TABLES))
def test_every_rule_is_reached(labelled, name):
    if name == "upper":
        return
    table, default = TABLES[name]
    got = {row[name] for row in labelled}
    assert default in got
    missing = {label for _, label in table} - got
    assert not missing


def test_null_title_and_dispatch(spark):
    df = spark.createDataFrame(
        [("Long-form", None), ("Short", "락"), ("Long-form", "락"), (None, "monday"), ("Unknown", "리노리방")],
        "f string, t string",
    )
    got = [r[0] for r in df.select(rules.content_pillar(F.col("f"), F.col("t"))).collect()]
    assert got == [None, "ROCK-STAR Era", "Other/Music Videos", "Celebrations & Birthdays", "Lee Know's Ri-Bang"]


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([("Short", "x")], "f string, t string").select(rules.content_pillar(F.col("f"), F.col("t")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan.replace("ExistingRDD", "")
