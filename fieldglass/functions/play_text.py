"""What a line of play-by-play text says: result codes, runners, outs, runs, pitches, noise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Result codes by the words that give them; the first that a text contains counts.
RESULT_CODES = [
    ("홈런", "HR"), ("3루타", "H3"), ("2루타", "H2"), ("내야안타", "IH"), ("안타", "H1"), ("1루타", "H1"), ("적시타", "H1"),
    ("낫 아웃", "K"), ("삼진", "K"), ("고의4구", "BB"), ("자동 고의4구", "BB"), ("볼넷", "BB"), ("몸에 맞는 볼", "HBP"), ("사구", "HBP"),
    ("야수선택", "FC"), ("희생플라이", "SF"), ("희플", "SF"), ("희생번트", "SH"), ("희번", "SH"), ("번트", "SH"), ("실책출루", "ROE"), ("실책", "E"),
    ("삼중살", "TP"), ("병살", "DP"), ("라인드라이브", "LD"), ("직선타", "LD"), ("뜬공", "FO"), ("플라이", "FO"), ("땅볼", "GO"),
    ("도루", "SB"), ("주루사", "CS"), ("견제사", "PO"), ("태그아웃", "CS"), ("송구아웃", "CS"), ("폭투", "WP"), ("포일", "PB"),
]
# Outcomes and directions, in order.
OUTCOMES = [
    ("홈런", "home_run"), ("3루타", "triple"), ("2루타", "double"), ("1루타", "single"), ("내야안타", "single"), ("삼진", "strikeout"), ("스트라이크", "strikeout"),
    ("볼넷", "walk"), ("고의4구", "intentional_walk"), ("몸에 맞는 볼", "hit_by_pitch"), ("사구", "hit_by_pitch"), ("희생번트", "sacrifice_hit"), ("희번", "sacrifice_hit"),
    ("희생플라이", "sacrifice_fly"), ("희플", "sacrifice_fly"), ("실책", "error"), ("병살", "double_play"), ("폭투", "wild_pitch"),
    ("견제사", "runner_out"), ("주루사", "runner_out"), ("태그아웃", "runner_out"), ("터치아웃", "runner_out"), ("직선타", "lineout"), ("땅볼", "groundout"), ("뜬공", "flyout"), ("플라이", "flyout"),
]
DIRECTIONS = [("좌", "left"), ("우", "right"), ("중", "center"), ("2루수", "second_base"), ("3루수", "third_base"), ("유격수", "shortstop"), ("1루수", "first_base"), ("포수", "catcher")]
HIT_TYPES = {"home_run": "hit", "single": "hit", "double": "hit", "triple": "hit", "flyout": "flyout", "groundout": "groundout", "lineout": "lineout", "sacrifice_fly": "flyout", "double_play": "groundout"}
# Codes by kind.
HITS = ("H1", "IH", "H2", "H3", "HR")
OUTS = ("K", "GO", "FO", "LD", "DP", "TP")
ON_BASE = (*HITS, "BB", "HBP", "FC", "ROE")
NO_APPEARANCE = ("SH", "SF", "SB", "CS", "PO", "WP", "PB")
# Lines that say nothing of a play.
NOISE_PATTERNS = [
    r"^\s*=+\s*$", r"^\d+회\s*(초|말)\s+.*공격\s*$", r"^\d+번타자\s+", r"^\d+구\s+(?:볼|스트라이크|파울|헛스윙|폭투|포일|중계|방어)",
    r"^(?:승리투수|패전투수|세이브|홀드)\s*:", r"^(?:경기|게임)\s*(?:시작|종료|중단|재개|취소)", r"^피치클락\s+위반",
]
NOISE_WORDS = [
    "경기 준비중", "경기 시작", "경기 종료", "경기 중단", "경기 재개", "게임 종료", "마운드 방문", "투수판 이탈", "코칭스태프", "피치클락", "피치클락 위반", "그라운드 정비", "우천",
    "비디오 판독", "심판 자체", "ABS 추적", "ABS 수신", "ABS 확인", "교체", "대타", "대주자", "대수비", "승리투수", "패전투수", "세이브", "홀드", "결승타", "MVP", "서스펜디드", "콜드게임",
]
RESULT_WORDS = [
    "안타", "1루타", "내야안타", "적시타", "홈런", "2루타", "3루타", "아웃", "삼진", "볼넷", "고의4구", "자동 고의4구", "사구", "몸에 맞는 볼", "실책", "희생", "희번", "희플", "번트", "플라이", "뜬공", "땅볼",
    "라인드라이브", "직선타", "병살", "삼중살", "야수선택", "도루", "주루사", "견제사", "태그아웃", "터치아웃", "송구아웃", "낫 아웃", "폭투", "포일", "홈인", "득점", "진루",
]
ADVANCES = ("홈인", "득점", "진루", "폭투", "포일")
RUNNER_OUTS = ("주루사", "견제사", "태그아웃")
PITCH = r"^([0-9]+)구\s+(볼|스트라이크|파울|헛스윙|폭투|포일)"
_WHITE = r"\s+"


def first_match(text: Column, pairs: list[tuple[str, str]]) -> Column:
    """What belongs to the first of the words that ``text`` contains, else NULL."""
    out = F.lit(None).cast("string")
    for word, value in reversed(pairs):
        out = F.when(text.contains(word), value).otherwise(out)
    return out


def any_of(text: Column, words) -> Column:
    """Whether ``text`` contains one of the words."""
    out = F.lit(False)
    for w in words:
        out = out | text.contains(w)
    return out


def compact(text: Column) -> Column:
    """Trimmed, with single blanks; NULL as empty."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), _WHITE, " "))


def after_colon(text: Column) -> Column:
    """What follows the first colon, or the whole text."""
    return F.trim(F.regexp_replace(F.trim(text), r"^[^:]*:", ""))


def result_code(text: Column) -> Column:
    return first_match(after_colon(text), RESULT_CODES)


def result_or_text(text: Column) -> Column:
    """The code of a text with a colon, else what follows the colon; NULL without one or with nothing after it."""
    rest = after_colon(text)
    return F.when(text.contains(":") & (rest != ""), F.coalesce(first_match(rest, RESULT_CODES), rest))


def outcome(text: Column) -> Column:
    """Stealing comes first, failed or not."""
    rest = _play(text)
    return F.when(rest.contains("도루"), F.when(rest.contains("실패"), "caught_stealing").otherwise("stolen_base")).otherwise(first_match(rest, OUTCOMES))


def direction(text: Column) -> Column:
    return first_match(_play(text), DIRECTIONS)


def hit_type(text: Column) -> Column:
    what, out = outcome(text), F.lit(None).cast("string")
    for k, v in HIT_TYPES.items():
        out = F.when(what == k, v).otherwise(out)
    return out


def _play(text: Column) -> Column:
    rest = after_colon(text)
    return F.when((rest != "") & (rest != "empty"), rest)


def runners(text: Column) -> Column:
    """Bases taken as bits 1, 2 and 4; a list like '1,2루' names each."""
    t = F.replace(F.replace(text, F.lit(","), F.lit("루 ")), F.lit("루루"), F.lit("루"))
    bit = lambda word, b: F.when(t.contains(word), b).otherwise(0)
    return F.when(text.contains("만루"), 7).otherwise(bit("1루", 1) + bit("2루", 2) + bit("3루", 4))


def outs(text: Column) -> Column:
    return F.when(any_of(text, ("2사", "투아웃")), 2).when(any_of(text, ("1사", "원아웃")), 1).otherwise(0)


def runs(text: Column) -> Column:
    """Runs that a text names, in digits or by the kind of home run."""
    said = F.regexp_extract(text, r"([0-9]+)점\s*(?:홈런|득점)", 1).try_cast("int")
    words = F.when(text.contains("솔로 홈런"), 1).when(text.contains("투런 홈런"), 2).when(text.contains("쓰리런 홈런"), 3).when(text.contains("만루 홈런"), 4).otherwise(0)
    return F.coalesce(said, words)


def is_noise(text: Column) -> Column:
    t = compact(text)
    out = t == ""
    for p in NOISE_PATTERNS:
        out = out | t.rlike(p)
    return out | any_of(t, NOISE_WORDS)


def is_result(text: Column) -> Column:
    t = compact(text)
    rest = after_colon(t)
    return ~is_noise(text) & t.contains(":") & ~rest.contains("교체") & any_of(rest, RESULT_WORDS)


def event_kind(text: Column) -> Column:
    """steal, runner_advance, runner_out, batting or unknown."""
    rest = after_colon(compact(text))
    kind = F.when(rest.contains("도루"), "steal").when(any_of(rest, ADVANCES), "runner_advance").when(any_of(rest, RUNNER_OUTS), "runner_out").otherwise("batting")
    return F.when(is_result(text), kind).otherwise("unknown")


def pitch(text: Column) -> Column:
    """The kind of a pitch line, NULL for other text."""
    return F.nullif(F.regexp_extract(compact(text), PITCH, 2), F.lit(""))


def pitch_balls(text: Column) -> Column:
    kind = pitch(text)
    return F.when(kind.isin("볼", "폭투"), 1).when(kind.isin("스트라이크", "헛스윙", "파울"), 0)


def pitch_strikes(text: Column) -> Column:
    kind = pitch(text)
    return F.when(kind.isin("볼", "폭투"), 0).when(kind.isin("스트라이크", "헛스윙", "파울"), 1)


def is_code(code: Column, codes) -> Column:
    """Whether a code is one of ``codes``; false for NULL and empty ones."""
    return F.coalesce(F.upper(code).isin(*codes), F.lit(False))


def is_plate_appearance(code: Column) -> Column:
    return F.coalesce((code != "") & ~F.upper(code).isin(*NO_APPEARANCE), F.lit(False))
