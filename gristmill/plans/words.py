"""Word and letter counts over the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from gristmill.functions import text
from gristmill.operators import words
from gristmill.plans import bindings as b
from gristmill.plans.registry import query

SPACE = r"\x09-\x0d\x1c-\x1f\x{85}\p{Z}"
WORD = r"\p{L}\p{N}_"

NORMAL = f"regexp_replace(lower(text), '[^{WORD}{SPACE}]', '', 'g')"


def words_sql(source: str, where: str = "true", table: str = "documents") -> str:
    """All words of a text expression, one per row."""
    return f"""
    SELECT word FROM (
        SELECT unnest(string_split_regex({source}, '[{SPACE}]+')) AS word
        FROM {table} WHERE {where})
    WHERE word <> ''"""


def counts_sql(source: str, min_length: int = 1) -> str:
    return f"""
    SELECT word, count(*) AS n FROM ({words_sql(source)})
    WHERE length(word) >= {min_length} GROUP BY word"""


LETTERS_SQL = f"""
SELECT substr(word, 1, 1) AS letter, count(*) AS n
FROM (SELECT unnest(string_split_regex(lower(text), '[^{WORD}]+')) AS word FROM documents)
WHERE regexp_full_match(word, '[a-z]+') GROUP BY 1"""

PLAIN_SQL = r"""
SELECT word, count(*) AS n
FROM (SELECT unnest(string_split_regex(
          lower(regexp_replace(text, '[^a-zA-Z0-9\x09-\x0d ]', '', 'g')),
          '[\x09-\x0d ]+')) AS word
      FROM documents)
GROUP BY word"""


@query(f"SELECT regexp_replace(word, '[^\\x00-\\x7F]', '', 'g') AS word, n "
       f"FROM ({counts_sql('text')}) "
       f"WHERE regexp_replace(word, '[^\\x00-\\x7F]', '', 'g') <> ''")
def word_count_ascii(spark, folder):
    return words.ascii_view(words.word_counts(b.text_lines(spark, folder), normalised=False))


@query(f"{counts_sql(NORMAL)} ORDER BY n DESC, word LIMIT 20")
def word_count_top20(spark, folder):
    return words.top(words.word_counts(b.text_lines(spark, folder)), 20, "word")


@query(f"{counts_sql(NORMAL, 6)} ORDER BY n DESC, word LIMIT 20")
def long_word_top20(spark, folder):
    counts = words.word_counts(b.text_lines(spark, folder), min_length=6)
    return words.top(counts, 20, "word")


@query(f"{counts_sql(NORMAL, 6)} ORDER BY n DESC, word LIMIT 20")
def collection_word_top20(spark, folder):
    """Same counts from the content field of the article collection."""
    lines = b.articles(spark, folder).select(text.joined(F.col("content")).alias("value"))
    return words.top(words.word_counts(lines, min_length=6), 20, "word")


@query(counts_sql("text"))
def word_count_raw(spark, folder):
    return words.word_counts(b.text_lines(spark, folder), normalised=False)


@query(LETTERS_SQL)
def letter_count(spark, folder):
    return words.letter_counts(b.text_lines(spark, folder))
