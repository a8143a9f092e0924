"""Display helpers: short codes, hues, labels and classes, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: short codes of teams, words that initials leave out, personas' tags
TEAM_CODES = {
    "Chennai Super Kings": "CSK", "Mumbai Indians": "MI", "Royal Challengers Bangalore": "RCB", "Royal Challengers Bengaluru": "RCB",
    "Sunrisers Hyderabad": "SRH", "Kolkata Knight Riders": "KKR", "Delhi Capitals": "DC", "Delhi Daredevils": "DD", "Punjab Kings": "PBKS",
    "Kings XI Punjab": "KXIP", "Rajasthan Royals": "RR", "Gujarat Titans": "GT", "Lucknow Super Giants": "LSG", "Deccan Chargers": "DEC",
    "Pune Warriors": "PW", "Pune Warriors India": "PW", "Rising Pune Supergiant": "RPS", "Rising Pune Supergiants": "RPS", "Gujarat Lions": "GL", "Kochi Tuskers Kerala": "KTK",
}
SMALL_WORDS = ("of", "the", "and")
TAGS = {"broadcast": "TV", "radio": "RADIO", "analyst": "ANALYST", "text": "WIRE"}


def _literal_map(pairs: dict) -> Column:
    return F.create_map(*(F.lit(x) for kv in pairs.items() for x in kv))


def initials(name: Column) -> Column:
    """First letters of the words that are not small, three at most; without any, the name's first three letters."""
    words = F.filter(F.split(name, r"\s+"), lambda w: (w != "") & ~F.lower(w).isin(*SMALL_WORDS))
    letters = F.substring(F.array_join(F.transform(words, lambda w: F.upper(F.substring(w, 1, 1))), ""), 1, 3)
    return F.when(letters != "", letters).otherwise(F.upper(F.substring(name, 1, 3)))


def team_code(name: Column, codes: dict[str, str] = TEAM_CODES) -> Column:
    return F.coalesce(F.try_element_at(_literal_map(codes), name), initials(name))


def hue(name: Column) -> Column:
    """A hue of 0 to 359 for any name: its code points folded as digits of base 31."""
    letters = F.filter(F.split(name, ""), lambda c: c != "")
    return F.aggregate(letters, F.lit(0), lambda h, c: (h * 31 + F.ascii(c)) % 360)


def ball_label(token: Column) -> Column:
    """What a token of the last deliveries stands for."""
    runs = F.concat(token, F.when(token == "1", " run").otherwise(" runs"))
    return F.when(token == "W", "Wicket").when(token == "6", "Six").when(token == "4", "Four").when(token == "0", "Dot ball").otherwise(runs)


def ball_class(token: Column) -> Column:
    return F.when(token == "W", "wicket").when(token.isin("4", "6"), "boundary").when(token == "0", "dot").otherwise("")


def round_label(round_: Column, semi_finals: Column) -> Column:
    """A round's heading; semi_finals: whether any match of the season is one."""
    return F.when(round_ == 3, "Final").when(round_ == 2, "Qualifier 2").when((round_ == 1) & semi_finals, "Semi-Finals").when(round_ == 1, "Playoffs").otherwise("Group Stage")


def persona_tag(key: Column) -> Column:
    return F.coalesce(F.try_element_at(_literal_map(TAGS), key), F.upper(key))


def is_blank(text: Column) -> Column:
    return ~F.coalesce(text, F.lit("")).rlike(r"(?U)\S")


def newest_first(feed: DataFrame, order: str) -> DataFrame:
    return feed.orderBy(F.desc(order))
