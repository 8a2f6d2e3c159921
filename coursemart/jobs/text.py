"""Word frequencies of text lines, optionally per attribute."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# English stopwords, and the additional ones of this domain.
ENGLISH_STOPWORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves he him his himself she
she's her hers herself it it's its itself they them their theirs themselves what which who whom this that that'll these
those am is are was were be been being have has had having do does did doing a an the and but if or because as until
while of at by for with about against between into through during before after above below to from up down in out on off
over under again further then once here there when where why how all any both each few more most other some such no nor
not only own same so than too very s t can will just don don't should should've now d ll m o re ve y ain aren aren't
couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't
needn needn't shan shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split()
DOMAIN_STOPWORDS = "monday tuesday wednesday thursday friday saturday sunday pm this 's".split()
STOPWORDS = tuple(dict.fromkeys([*ENGLISH_STOPWORDS, *DOMAIN_STOPWORDS]))

ALL = "all"

# The words the Treebank rules take apart although they hold letters only.
CONTRACTIONS = "cannot gimme gonna gotta lemme wanna".split()

# The Penn Treebank word-splitting rules, as (pattern, replacement) applied one after the other.
FINAL_STOP = r"""([^\.])(\.)([\]\)}>"']*)\s*\z"""
TREEBANK_RULES = (
    # opening quotes
    (r'^"', r"``"),
    (r"(``)", r" $1 "),
    (r"""([ (\[{<])("|'{2})""", r"$1 `` "),
    # punctuation
    (r"([:,])([^\d])", r" $1 $2"),
    (r"([:,])\z", r" $1 "),
    (r"\.\.\.", r" ... "),
    (r"([;@#$%&])", r" $1 "),
    (FINAL_STOP, r"$1 $2$3 "),
    (r"([?!])", r" $1 "),
    (r"([^'])' ", r"$1 ' "),
    # brackets and dashes
    (r"([\]\[\(\)\{\}\<\>])", r" $1 "),
    (r"--", r" -- "),
    # the text gets a space on either side
    (r"^", r" "),
    (r"\z", r" "),
    # closing quotes
    (r"''", r" '' "),
    (r'"', r" '' "),
    (r"([^' ])('[sS]|'[mM]|'[dD]|') ", r"$1 $2 "),
    (r"([^' ])('ll|'LL|'re|'RE|'ve|'VE|n't|N'T) ", r"$1 $2 "),
    # contractions
    (r"(?i)\b(can)(not)\b", r" $1 $2 "),
    (r"(?i)\b(d)('ye)\b", r" $1 $2 "),
    (r"(?i)\b(gim)(me)\b", r" $1 $2 "),
    (r"(?i)\b(gon)(na)\b", r" $1 $2 "),
    (r"(?i)\b(got)(ta)\b", r" $1 $2 "),
    (r"(?i)\b(lem)(me)\b", r" $1 $2 "),
    (r"(?i)\b(more)('n)\b", r" $1 $2 "),
    (r"(?i)\b(wan)(na)(\s)", r" $1 $2 $3"),
    (r"(?i) ('t)(is)\b", r" $1 $2 "),
    (r"(?i) ('t)(was)\b", r" $1 $2 "),
)


def _treebank(text: Column, ends_line: Column | None = None) -> Column:
    for pattern, replacement in TREEBANK_RULES:
        # Letters outside ASCII are letters, at word boundaries too.
        pattern = pattern.replace("(?i)", "(?iU)")
        replaced = F.regexp_replace(text, pattern, replacement)
        if pattern == FINAL_STOP and ends_line is not None:
            replaced = F.when(ends_line, replaced).otherwise(text)
        text = replaced
    return F.filter(F.split(text, r"\s+"), lambda token: token != "")


def treebank_tokens(line: Column | str) -> Column:
    """The words of one line after the Treebank rules, as an array."""
    return _treebank(F.col(line) if isinstance(line, str) else line)


def treebank_counts(lines: DataFrame) -> DataFrame:
    """(attribute, token, n) of (attribute, line) by the Treebank rules.

    No rule looks further than the space around a word, except that a full stop counts only at the end of the line. So lines
    are cut at spaces, equal pieces are counted first (combined before the shuffle), and the thirty regular expressions run
    once per distinct piece instead of once per line. Lines with other white space (tabs, say) stay one piece.
    """
    cut = F.when(F.rlike("line", F.lit(r"[^\S ]")), F.array("line")).otherwise(
        F.regexp_extract_all("line", F.lit(r" *\S+ *"), 0)
    )
    placed = lines.select("attribute", cut.alias("_cut")).select(
        "attribute", F.size("_cut").alias("_size"), F.posexplode("_cut").alias("_i", "_text")
    )
    # Each piece carries the spaces on both of its sides.
    pieces = placed.selectExpr(
        "attribute",
        "CASE WHEN _i > 0 THEN concat(' ', _text) ELSE _text END AS piece",
        "_i = _size - 1 AS ends_line",
    )
    distinct = pieces.groupBy("attribute", "piece", "ends_line").agg(F.count("*").alias("n"))
    # Most pieces are one word of letters or digits. No rule applies to those, contractions excepted.
    word = F.regexp_extract("piece", r"^\s*([\p{L}\p{M}\p{N}]+)\s*$", 1)
    marked = distinct.select("attribute", "piece", "ends_line", "n", word.alias("word"))
    plain = (F.col("word") != "") & ~F.lower("word").isin(*CONTRACTIONS)
    tokens = F.when(plain, F.array("word")).otherwise(_treebank(F.col("piece"), F.col("ends_line")))
    return marked.select("attribute", F.explode(tokens).alias("token"), "n")


def word_counts(lines: DataFrame) -> DataFrame:
    """(attribute, token, n) by runs of letters, digits and apostrophes: cheaper, and good for any Unicode text."""
    runs = F.regexp_extract_all("line", F.lit(r"[\p{L}\p{N}_']+"), 0)
    return lines.select("attribute", F.explode(runs).alias("token"), F.lit(1).alias("n"))


TOKENIZERS = {"treebank": treebank_counts, "words": word_counts}


def split_attribute_prefix(lines: DataFrame, line: str = "line") -> DataFrame:
    """``attribute,text`` lines as (attribute, text); lines without a comma are left out."""
    whole = F.col(line)
    return lines.where(F.contains(whole, F.lit(","))).select(
        F.substring_index(whole, ",", 1).alias("attribute"),
        F.substring(whole, F.instr(whole, ",") + F.lit(1), F.length(whole)).alias("text"),
    )


def word_frequency(
    lines: DataFrame,
    text: str,
    attribute: str | None = None,
    stopwords: Iterable[str] = STOPWORDS,
    tokenizer: str = "treebank",
) -> DataFrame:
    """(attribute, word, frequency).

    Stopwords go before the words are lower-cased, so ``The`` at the start of a sentence survives as ``the``; so do
    one-character and purely numeric tokens go. Without ``attribute`` all words count under ``all``. ``tokenizer`` is
    ``treebank`` (for single lines of English) or ``words``.
    """
    label = F.lit(ALL) if attribute is None else F.col(attribute)
    tokens = TOKENIZERS[tokenizer](lines.select(label.alias("attribute"), F.col(text).alias("line")))
    kept = tokens.where(
        (F.length("token") > 1) & ~F.col("token").isin(*stopwords) & ~F.rlike("token", F.lit(r"^\p{N}+$"))
    )
    return kept.groupBy("attribute", F.lower("token").alias("word")).agg(F.sum("n").alias("frequency"))
