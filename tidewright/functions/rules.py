"""Title rules: ordered (pattern, label) tables compiled to one CASE Column.

The patterns are written for a regex dialect in which ``(?i)``, ``\\w`` and ``\\s`` are Unicode-aware
and only a newline ends a line. Java needs the flags ``U`` and ``d`` for the same reading, which
`java_pattern` adds; nothing runs in Python workers.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewright.schemas import LONG_FORM, SHORT

# Rule patterns and labels, first match wins.
LONG_FORM_RULES = [
    (r"(?i)SKZ-TALKER GO!", "SKZ-TALKER GO!"),
    (r"(?i)SKZ-TALKER|슼토커|슼즈토커", "SKZ-TALKER"),
    (r"\[SKZ CODE\]", "SKZ CODE"),
    (r"(?i)Kids?'?s?\s*(Room|Song|Show)", "Kids Room Series"),
    (r"\[SKZ VLOG\]|\[RACHA LOG\]|\[SKZ LOG\]", "Vlogs & Logs"),
    (r"(?i)SKZ-RECORD|SKZ-PLAYER|\[SONG by\]", "SKZ-RECORD / PLAYER"),
    (r"(?i)제 9구역|The 9th", "The 9th"),
    (r"\[SPOT KIDS", "SPOT KIDS"),
    (r"(?i)M/V Reaction", "M/V Reaction"),
    (r"(?i)MAKING FILM", "Making Film"),
    (r"(?i)Dance Practice|Performance Video|Guide Video|Lyric Visualizer", "Dance & Performance"),
]
LONG_FORM_DEFAULT = "Other/Music Videos"

SHORT_RULES = [
    (r"(?i)Challenge\s+w/|챌린지\s+w/", "Collab Challenge"),
    (r"(?i)Behind-the-scenes", "Behind Content"),
    (r"(?i)SKZCODE|스키즈코드", "SKZ CODE Shorts"),
    (r"(?i)SKZ_TALKER_GO|슼즈토커고", "SKZ-TALKER GO!"),
    (
        r"(?i)dominATE|MANIAC|FANMEETING|World Tour|STAY_in_Our_Little_House|SKZ_5CLOCK",
        "Concert & Fanmeeting",
    ),
    (r"(?i)SONGby|송바이|SKZ_PLAYER|슼즈플레이어|Cover by", "Music Cover / Solo Release"),
    (r"(?i)birthday|Happy\w+Day", "Member Birthday"),
    (r"(?i)WalkinOnWater|合|HOP|Youth|ULTRA|SoGood|Holdmyhand|As_we_are|HALLUCINATION", "HOP Era"),
    (r"(?i)DO_IT|Do_It|신선놀음|DIVINE", "DO IT Era"),
    (r"(?i)ATE|ChkChkBoom|ILikeIt|JJAM|MOUNTAINS", "ATE Era"),
    (r"(?i)LoseMyBreath|LMB_Challenge|숨멎챌", "Lose My Breath Era"),
    (r"(?i)樂_STAR|ROCK_STAR|락|樂|LALALALA", "ROCK-STAR Era"),
    (r"(?i)5_STAR|특|S_Class", "5-STAR Era"),
    (r"(?i)CASE143|CASE143Challenge", "Case 143 Era"),
    (r"(?i)치즈챌린지|CHEESEchallenge|소리꾼챌린지|ThunderousChallenge", "NOEASY Era"),
]
SHORT_DEFAULT = "General Promo / Other Shorts"

LIVE_RULES = [
    (r"찬이의.*방", "Chan's Room"),
    (r"리노리방", "Lee Know's Ri-Bang"),
    (r"(?i)생일|탄신일|탄생|데이|day|anniversary|birthday", "Celebrations & Birthdays"),
    (
        r"(?i)countdown|unveil|라이브\s*스트림|팬미팅|콘서트|리허설|가요대전|언박싱",
        "Official Promos & Events",
    ),
]
LIVE_DEFAULT = "Casual & Unit Lives"

# Applied to the upper-cased title.
UPPER_RULES = [
    (r"SKZ CODE|SKZCODE", "SKZ CODE"),
    (r"2 KIDS ROOM|TWO KIDS ROOM", "2 Kids Room"),
    (r"1 KIDS ROOM", "1 Kids Room"),
    (r"SKZ-TALKER|SKZ TALKER", "SKZ-TALKER"),
    (r"SKZ-PLAYER|SKZ-RECORD", "SKZ-PLAYER/RECORD"),
    (r"UNVEIL : TRACK|M/V TEASER|TRAILER", "Teaser/Trailer"),
    (r"M/V$|MUSIC VIDEO", "Official M/V"),
    (r"VLOG", "Vlog"),
]
UPPER_DEFAULT = "Other/Misc"


def java_pattern(pattern: str) -> str:
    """Same pattern for Java's engine: Unicode classes and case folding, newline-only line ends."""
    if pattern.startswith("(?i)"):
        return "(?iUd)" + pattern[len("(?i)"):]
    return "(?Ud)" + pattern


def needles(pattern: str) -> list[str]:
    """Literal text that a match must contain: the leading literal of every alternative."""
    body = pattern.removeprefix("(?i)")
    found = []
    for alternative in [body] if "(" in body else body.split("|"):
        run = re.match(r"(?:[^\\.^$*+?{}\[\]|()]|\\[\[\]])*", alternative).group()
        if alternative[len(run) : len(run) + 1] in ("?", "*", "{"):
            run = run[:-1]
        found.append(re.sub(r"\\(.)", r"\1", run))
    if not all(found):
        raise ValueError(f"rule without a literal start: {pattern}")
    return found


def folded(subject: Column) -> Column:
    """Lower case in which all letters that match a plain i, s or k without case are equal."""
    return F.lower(F.translate(subject, "\u0130\u0131\u017f\u212a", "iisk"))


def rule_matches(subject: Column, pattern: str) -> Column:
    """The regex runs only on texts that contain one of its needles: a substring search is cheaper
    than a case-insensitive alternation, and hits are rare."""
    if pattern.startswith("(?i)"):
        hits = [F.contains(folded(subject), F.lit(n.lower())) for n in needles(pattern)]
    else:
        hits = [F.contains(subject, F.lit(n)) for n in needles(pattern)]
    return reduce(lambda a, b: a | b, hits) & subject.rlike(java_pattern(pattern))


def first_match(subject: Column, rules: list[tuple[str, str]], default: str) -> Column:
    """Label of the first matching rule; null subjects stay null.

    The null check comes last, so that the folded text of the first condition is always evaluated
    and shared by all others.
    """
    chain = F
    for pattern, label in rules:
        chain = chain.when(rule_matches(subject, pattern), F.lit(label))
    return chain.otherwise(F.when(subject.isNotNull(), F.lit(default)))


def long_form_pillar(title: Column) -> Column:
    return first_match(title, LONG_FORM_RULES, LONG_FORM_DEFAULT)


def short_pillar(title: Column) -> Column:
    return first_match(title, SHORT_RULES, SHORT_DEFAULT)


def live_pillar(title: Column) -> Column:
    return first_match(title, LIVE_RULES, LIVE_DEFAULT)


def content_pillar(video_format: Column, title: Column) -> Column:
    """Rule set by format; every other format, including null, uses the live rules."""
    return (
        F.when(video_format == LONG_FORM, long_form_pillar(title))
        .when(video_format == SHORT, short_pillar(title))
        .otherwise(live_pillar(title))
    )


def title_category(title: Column) -> Column:
    """The alternative categoriser over upper-cased titles."""
    return first_match(F.upper(title), UPPER_RULES, UPPER_DEFAULT)
