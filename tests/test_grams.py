import pytest
from pyspark.sql import functions as F

from ludolake.operators.grams import gram_rows, gram_table, grams_of, having_all
from ludolake.plans.serving import name_grams, search_games
from tests.test_plans import named_dim

NAMES = ["Mario Kart", "mario", "Super MARIO 64", "Straße", "STRASSE", "a\\b_c%d", "ab", "", None, "İstanbul", "x" * 700 + "needle", "Mar io"]


@pytest.fixture(scope="module")
def dim(spark):
    names = spark.createDataFrame(list(enumerate(NAMES)), "game_id long, name string")
    rows = named_dim(spark, range(len(NAMES))).drop("game_name").join(names, "game_id").withColumnRenamed("name", "game_name")
    return rows.withColumn("first_release_date", F.col("game_id") * 86_400 * 400).cache()


@pytest.mark.parametrize("term", [
    "mario", "MARIO", " io ", "a", "ss", "ß", "strasse", "\\b_c", "m_rio", "mar%64", "%%", "needle", "xxxneed", "zzz", "i̇st", "İST", "", None, "mario kart!",
])
def test_same_games_with_and_without_the_table(dim, term):
    plain = search_games(dim, term)
    assert search_games(dim, term, grams=name_grams(dim)).collect() == plain.collect()


def test_grams_of_long_and_short_texts(spark):
    texts = spark.createDataFrame([(1, "aaaa"), (2, "ab"), (3, None), (4, "Abcd" * 200), (4, "abc")], "id long, t string")
    got = sorted(tuple(r) for r in gram_rows(texts, "id", "t").collect())
    assert got == [("aaa", 1), ("abc", 4), ("bcd", 4), ("cda", 4), ("dab", 4)]
    assert grams_of(spark, "ab_CDEF%g") == ["cde", "def"] and grams_of(spark, "a_b%") == []


def test_most_of_the_table_is_not_read(spark, tmp_path):
    """The scan gives the rows of the few row groups, or pages, that hold the grams of the term."""
    names = spark.range(20_000).selectExpr("id AS game_id", "concat(hex(id * 7919), ' number ', id) AS game_name")
    path = f"{tmp_path}/grams"
    gram_table(names, "game_id", "game_name").write.option("parquet.block.size", str(1 << 17)).parquet(path)
    table = spark.read.parquet(path)
    hits = table.where(F.col("gram").isin(grams_of(spark, "r 1999")))
    found = [r.game_id for r in hits.select("game_id").collect()]
    leaf = hits.select("game_id")
    leaf.collect()
    scan = leaf._jdf.queryExecution().executedPlan().collectLeaves().head()
    read = scan.metrics().get("numOutputRows").get().value()
    assert 0 < len(found) <= read < table.count() / 3
    assert sorted(r.game_id for r in having_all(table, "game_id", grams_of(spark, "r 1999")).collect()) == [1999, *range(19_990, 20_000)]
