from pyspark.sql import functions as F

from ludolake.llm import mixing, ngram_join

NAMES = ("_digest", "_id", "_key", "_source", "_at", "_text", "_words", "_take", "_turns", "_row", "_doc", "_rows", "_pieces")


def rows_of(frame, columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


def test_names_of_the_operators_own_columns(odd):
    taken = odd.select("*", *(F.lit(7).alias(n) for n in NAMES))
    for step in (ngram_join.keep_one, mixing.mixed_documents):
        plain, other = step(odd), step(taken)
        assert other.columns == taken.columns
        assert rows_of(other, odd.columns) == rows_of(plain, odd.columns)
        assert other.where("_digest <> 7 OR _key <> 7 OR _doc <> 7").count() == 0
