"""What a line claims, read in one pass by compiled patterns, as an Arrow function over columns.

Digits, white space and word boundaries are those of Unicode. Numbers come back as their
decimal digits, without leading zeros, so that they may be of any length.
"""

import re

import pyarrow as pa
from pyspark import cloudpickle

# fixed values: words and phrases with a set meaning in these texts, and how far around a claim they count
NUMBERS = ("one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten")
ORDINALS = ("first", "second", "third", "fourth", "fifth", "sixth", "seventh", "eighth", "ninth", "tenth")
DISMISSED = ("bowled", "caught", "lbw", "stumped", "dismissed", "castled")
SCORE = r"(?<!\d)(\d+)\s*/\s*(\d+)"
EQUATION = r"(?<!\d)(\d+)\s+(?:(?:runs?|more|still|needed|required|now|to\s+win|to\s+get)\s+)*(?:off|from)\s+(?:the\s+)?(?:last\s+|final\s+|remaining\s+)?(\d+)"
CHASING = r"need|requir|to\s+win|to\s+get|chase"
SHOT = r"\b(four|six)\b"
COUNTED_AFTER = r"\s+(?:down|wickets?|overs?|balls?|for\b|(?:runs?\s+)?(?:an|per)\s+overs?)"
COUNTED_BEFORE = rf"(?:inside|over|first|final|last|opening)\s+$|(?:\d+|\b(?:{'|'.join(NUMBERS)}))\s+for\s+$|\d\s*/\s*$"
BIG_HIT = r"\b(?:maximum|sixer)\b"
DOWN = rf"\b(\d+|{'|'.join(NUMBERS)})\s+(?:wickets?\s+)?down\b(?!\s+(?:the|to|towards|over|past|into|at|and\s+out))"
FALLEN = rf"\b({'|'.join(ORDINALS)})\s+(?:wickets?\s+(?:to\s+fall|down)|to\s+fall)\b"
LOSING = rf"\blos(?:e|es|t|ing)\s+(?:their|its|his)\s+({'|'.join(ORDINALS)})\b"
OUT = r"run out|(?<![a-z'])(?:" + "|".join(DISMISSED) + r")(?![a-z'])"
SHOT_AROUND, EQUATION_AROUND = (18, 16), (22, 12)

_P = {k: re.compile(v) for k, v in {"score": SCORE, "equation": EQUATION, "chasing": CHASING, "shot": SHOT, "after": COUNTED_AFTER, "before": COUNTED_BEFORE, "big": BIG_HIT, "down": DOWN, "fallen": FALLEN, "losing": LOSING, "out": OUT}.items()}
_PLACES = {w: str(i) for words in (NUMBERS, ORDINALS) for i, w in enumerate(words, 1)}

_PAIR = pa.struct([("a", pa.string()), ("b", pa.string())])
CLAIMS = pa.struct([("score", _PAIR), ("equation", _PAIR), ("fallen", pa.string()), ("six", pa.bool_()), ("big", pa.bool_()), ("four", pa.bool_()), ("out", pa.bool_())])
DDL = "struct<score: struct<a: string, b: string>, equation: struct<a: string, b: string>, fallen: string, six: boolean, big: boolean, four: boolean, out: boolean>"


def digits(number: str) -> str:
    """A number's ASCII digits without leading zeros."""
    return "".join(str(int(c)) for c in number).lstrip("0") or "0"


def _pair(match) -> dict | None:
    return match and {"a": digits(match[1]), "b": digits(match[2])}


def _stands(match, text: str, reach: tuple[int, int]) -> tuple[str, str]:
    """What stands before and after a match."""
    return text[max(0, match.start() - reach[0]) : match.start()], text[match.end() : match.end() + reach[1]]


def read(text: str) -> dict:
    """All claims of a line: its first score, its first equation of a chase, wickets fallen, and whether it has a six, another word for one, a four, a dismissal."""
    low = text.lower()
    shots = set()
    for m in _P["shot"].finditer(low):
        if m[1] not in shots:
            before, after = _stands(m, low, SHOT_AROUND)
            if not (_P["after"].match(after) or _P["before"].search(before)):
                shots.add(m[1])
    chases = (m for m in _P["equation"].finditer(text) if _P["chasing"].search(m[0].join(_stands(m, text, EQUATION_AROUND)).lower()))
    nth = _P["down"].search(low) or _P["fallen"].search(low) or _P["losing"].search(low)
    return {
        "score": _pair(_P["score"].search(text)),
        "equation": _pair(next(chases, None)),
        "fallen": nth and (_PLACES.get(nth[1]) or digits(nth[1])),
        "six": "six" in shots,
        "big": bool(_P["big"].search(low)),
        "four": "four" in shots,
        "out": bool(_P["out"].search(low)),
    }


#: How a line can contradict its event: which events are contradicted, by what, and what is said of it.
_EVENTS = (
    ({"SIX"}, lambda c: c["four"], "calls a six a four"),
    ({"FOUR"}, lambda c: c["six"] or c["big"], "calls a four a six"),
    ({"WICKET", ""}, lambda c: c["six"] or c["big"], "claims a six that did not happen"),
    ({"WICKET", ""}, lambda c: c["four"], "claims a boundary that did not happen"),
    ({"SIX", "FOUR", ""}, lambda c: c["out"], "claims a wicket that did not happen"),
)


def contradictions(said: dict, event: str, true: dict) -> list[str]:
    """How a line's claims contradict its event and what its state claims, in a fixed order."""
    kind = next((k for k in ("SIX", "FOUR", "WICKET") if event.startswith(k)), "")
    found = [reason for kinds, claimed, reason in _EVENTS if kind in kinds and claimed(said)]
    shown = lambda pair: f"({pair['a']}, {pair['b']})"
    facts = [(what, said[what], true[what], shown) for what in ("score", "equation")]
    facts.insert(1, ("wickets", said["fallen"], true["score"] and true["score"]["b"], str))
    return found + [f"{what} {show(x)} != state {show(y)}" for what, x, y, show in facts if x is not None and y is not None and x != y]


class Checker:
    """Checks lines, and reads each distinct one of the last few thousand once."""

    def __init__(self, most: int = 4096) -> None:
        self.most, self.known = most, {}

    def claims(self, text: str | None) -> dict:
        if (found := self.known.get(text)) is None:
            if len(self.known) >= self.most:
                self.known.clear()
            found = self.known[text] = read(text or "")
        return found

    def __call__(self, line: str | None, event: str | None, state: str | None) -> list[str]:
        return contradictions(self.claims(line), event or "", self.claims(state))


CHECK = pa.struct([("ok", pa.bool_()), ("reasons", pa.list_(pa.string()))])


def check_columns(line: pa.Array, event: pa.Array, state: pa.Array) -> pa.Array:
    """(ok, reasons) of lines, events and states."""
    check = Checker()
    found = [check(*row) for row in zip(line.to_pylist(), event.to_pylist(), state.to_pylist(), strict=True)]
    return pa.array([{"ok": not why, "reasons": why} for why in found], CHECK)


def first_line(text: str | None) -> str:
    """A draw cut to its first line, trimmed."""
    return next(iter((text or "").strip().splitlines()), "").strip()


VALIDATED = pa.struct([("line", pa.string()), ("faithful", pa.bool_()), ("source", pa.string()), ("attempts", pa.int32()), ("reasons", pa.list_(pa.string()))])


class Drawing:
    """The state of a row whose line is drawn again until one holds."""

    def __init__(self) -> None:
        self.line, self.attempts, self.reasons = None, 0, []

    def offer(self, text: str | None, why) -> None:
        """One more draw; why gives the reasons against a line."""
        line = first_line(text)
        self.attempts += 1
        if line:
            self.reasons = why(line)
            self.line = None if self.reasons else line

    def result(self, fallback: str | None) -> dict:
        drawn = self.line is not None
        return {"line": self.line if drawn else fallback, "faithful": True, "source": "model" if drawn else "fallback", "attempts": self.attempts, "reasons": self.reasons}


def validate_columns(draws: pa.Array, event: pa.Array, state: pa.Array, fallback: pa.Array) -> pa.Array:
    """The first draw of each list that holds, or the fallback."""
    check, out = Checker(), []
    for texts, e, s, other in zip(*(c.to_pylist() for c in (draws, event, state, fallback)), strict=True):
        row = Drawing()
        for text in texts or []:
            row.offer(text, lambda line, e=e, s=s: check(line, e, s))
            if row.line is not None:
                break
        out.append(row.result(other))
    return pa.array(out, VALIDATED)


def read_column(lines: pa.Array) -> pa.Array:
    """The claims of a column of lines, each distinct one read once; a null line claims nothing."""
    known = lines.dictionary_encode()
    found = pa.array([read(x or "") for x in known.dictionary.to_pylist()] + [read("")], CLAIMS)
    return found.take(known.indices.fill_null(len(known.dictionary)))


# workers get these functions by value, so they need not find the package
cloudpickle.register_pickle_by_value(__import__(__name__, fromlist=["_"]))
