"""Text operators on prompts and model answers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Marks in prompts and answers.
TASK_MARK = "[任务]"
ANSWER_MARK = "答案："
# Unicode's white space, which trim() takes off without a pattern being matched.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    """Without Unicode white space at either end."""
    return F.trim(c, F.lit(WHITE))


def filled_lines(c: Column) -> Column:
    """Stripped lines that are not empty."""
    return F.filter(F.transform(F.split(c, "\n"), strip), lambda x: x != "")


def turn_in_line(line: Column) -> Column:
    """Turn of a raw line, with the bracket before it; null where there is none."""
    return F.regexp_extract(line, r"\(第([0-9]+)巡", 1).try_cast("int")


def turn_in_text(text: Column) -> Column:
    """Turn of a text, with or without bracket; null where there is none."""
    return F.regexp_extract(text, r"第([0-9]+)巡", 1).try_cast("int")


def bucket(turn: Column) -> Column:
    """Four stages; turn 0 is early."""
    return F.when(turn <= 3, "early").when(turn <= 6, "mid_pre").when(turn <= 12, "mid_mid").when(turn.isNotNull(), "late")


def category(turn: Column) -> Column:
    """Three stages; null and turn 0 are unknown."""
    return F.when(turn.between(1, 6), "early").when(turn.between(7, 12), "mid").when(turn >= 13, "late").otherwise("unknown")


def gold_answer(text: Column) -> Column:
    """The last filled line that opens no section; empty where there is none."""
    lines = F.filter(filled_lines(F.coalesce(text, F.lit(""))), lambda x: ~x.startswith("["))
    return F.coalesce(F.try_element_at(lines, F.lit(-1)), F.lit(""))


def clean_prompt(text: Column) -> Column:
    """The prompt without the answer: of a task section the first filled line stays, other lines that open no section go."""
    start = F.struct(F.lit(False).alias("task"), F.lit(False).alias("told"), F.array().cast("array<string>").alias("out"))

    def step(a: Column, line: Column) -> Column:
        opens = line.startswith(TASK_MARK)
        section = line.startswith("[")
        blank = strip(line) == ""
        inside = a["task"] & ~opens
        drop = inside & ~blank & ~section & a["told"]
        return F.struct(
            (opens | (inside & (blank | ~section))).alias("task"),
            F.when(opens, False).when(inside & ~blank & section, False).when(inside & ~blank, True).otherwise(a["told"]).alias("told"),
            F.when(drop, a["out"]).otherwise(F.concat(a["out"], F.array(line))).alias("out"),
        )

    return F.aggregate(F.split(text, "\n"), start, step, lambda a: F.array_join(a["out"], "\n"))


def _until_stop(c: Column) -> Column:
    """A stripped text up to the first full stop of each kind that it does not begin with, stripped."""
    return strip(F.regexp_extract(c, r"^(\.[^。]*|。[^.]*|[^.。]*)", 1))


def _until_comma(c: Column) -> Column:
    """A stripped text up to the first comma, if ten characters at most are before it but for white space."""
    return F.regexp_replace(c, f"(?s)^([^，]{{1,10}}?)[{WHITE}]*，.*$", "$1")


def _cut(c: Column) -> Column:
    """A stripped line up to the first full stop of either kind, then up to a comma that follows ten characters at most.

    Each step names the text once, since one that is named twice is worked out twice.
    """
    return F.trim(_until_comma(_until_stop(c)), F.lit("*_"))


def extract_answer(answer: Column) -> Column:
    """The answer in a model's words; empty and null come back as they are."""
    marked = F.contains(answer, F.lit(ANSWER_MARK))
    after = strip(F.substr(answer, F.locate(ANSWER_MARK, answer) + len(ANSWER_MARK)))
    # of a stripped text the first and the last line are filled
    line = strip(F.when(marked, F.substring_index(after, "\n", 1)).otherwise(F.substring_index(strip(answer), "\n", -1)))
    return F.when(F.coalesce(answer, F.lit("")) == "", answer).when(marked & (after == ""), strip(answer)).otherwise(_cut(line))


def is_blank(c: Column) -> Column:
    return F.coalesce(strip(c), F.lit("")) == ""


def score(answer: Column, gold: Column, correct: float = 1.0, wrong: float = 0.0, extracted: Column | None = None) -> Column:
    """correct if the extracted answer (worked out here if it is not given) is the gold answer, else wrong."""
    found = extract_answer(answer) if extracted is None else extracted
    hit = (F.coalesce(answer, F.lit("")) != "") & (F.coalesce(gold, F.lit("")) != "") & (found == strip(gold))
    return F.when(hit, F.lit(float(correct))).otherwise(F.lit(float(wrong)))


# A JSON list of strings without escapes and whole numbers that begins with such a string: what is seen without a parser.
_PLAIN_LIST = r'^\["([^"\\\x00-\x1f]*)"(?:,(?:"[^"\\\x00-\x1f]*"|[1-9][0-9]{0,8}))*\]\z'


def first_of_mixed(answer: Column) -> Column:
    """An answer that may be a JSON list [content, tokens, tokens, tokens]: its first element, or the answer itself."""
    plain = F.when(F.rlike(answer, F.lit(_PLAIN_LIST)), F.regexp_extract(answer, _PLAIN_LIST, 1))
    return plain.when(F.contains(answer, F.lit("[")), F.coalesce(F.get(F.from_json(answer, "array<string>"), 0), answer)).otherwise(answer)


def base_name(path: Column) -> Column:
    """The last part of a path with either kind of slash."""
    return F.substring_index(F.replace(path, F.lit("\\"), F.lit("/")), "/", -1)


def safe_name(name: Column) -> Column:
    """A name that can be part of a path."""
    return F.regexp_replace(name, r'[<>:"/\\|?*]', "_")


def ratios_are_valid(early: Column, mid: Column, late: Column) -> Column:
    """valid_ratios() of numbers in columns; null is not valid."""
    parts = [early, mid, late]
    inside = parts[0].between(0, 1) & parts[1].between(0, 1) & parts[2].between(0, 1)
    return F.coalesce(inside & (F.abs(early + mid + late - 1) < 0.001), F.lit(False))


def valid_ratios(ratios: dict[str, float]) -> bool:
    """Whether the ratios are for early, mid and late, each 0 to 1, and add up to 1."""
    if set(ratios) != {"early", "mid", "late"}:
        return False
    if any(isinstance(r, bool) or not isinstance(r, int | float) or not 0 <= r <= 1 for r in ratios.values()):
        return False
    return abs(sum(ratios.values()) - 1) < 0.001
