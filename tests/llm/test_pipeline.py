import public_tokenizers
import pytest
from tokenizers import Tokenizer

from test_decontaminate import brute as contained
from test_ngram_join import brute as components


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    en = "the of and with from that this have been water house never alone under green light"
    de = "der die und mit von dass dieses haben wurde wasser haus niemals allein unter licht"
    import random

    rng = random.Random(10)
    item = " ".join(rng.choices(en.split(), k=30))
    rows = []
    for i in range(120):
        lang = "en" if i % 3 else "de"
        words = rng.choices((en if lang == "en" else de).split(), k=rng.choice([6, 30, 80]))
        rows.append((i, " ".join(words), lang, "s", 1))
    rows += [(200 + i, rows[i][1], rows[i][2], "s", 1) for i in range(30)]
    rows += [(300, "the water " + item + " of light", "en", "s", 1), (301, None, "en", "s", 1), (302, "", None, "s", 1)]
    rows += [(303, "12 34 --", "en", "s", 1), (304, 'of the house token = "0123456789abcdef0123" in water', "en", "s", 1)]
    rows += [(304, 'of the house token = "0123456789abcdef0123" in water', "en", "s", 1), (5, "another text of that id", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.withColumn("label", docs.lang).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), rows, [(1, item)]


def test_stages_equal_brute_force(spark, folder):
    import corpus_pipeline as cp

    path, rows, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    one = [tuple(r) for r in cp.identify_language(spark, docs, path).collect()]
    assert {r[0] for r in rows} - {r[0] for r in one} == {301, 302, 303}
    given = spark.createDataFrame(one, docs.select(*cp.COLUMNS).schema)
    two = cp.drop_near_copies(spark, given, path)
    assert two.columns == cp.COLUMNS
    kept = sorted((r.doc_id, r.text) for r in two.collect())
    groups = {c for _, _, c in components([(r[0], r[1]) for r in one])}
    assert len(kept) == len(groups) + 1  # id 5 leads two groups
    assert {k for k, _ in kept} == groups
    three = [(r.doc_id, r.text) for r in cp.remove_benchmark_items(spark, two, path).collect()]
    assert sorted(three) == sorted(r for r in kept if not contained([r], items))
    assert 300 in {k for k, _ in kept} and 300 not in {k for k, _ in three}


def test_whole_pipeline(spark, folder):
    import corpus_pipeline as cp

    path, _, _ = folder
    assert [len(s) for s in cp.STAGES] == [2] * 5
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = {r.doc_id: r for r in cp.run(spark, path).collect()}
    text = "of the house [SECRET]\" in water"
    assert found[304].token_ids == library.encode(text, add_special_tokens=False).ids
    assert found[304].n_chars == len(text) and found[304].n_tokens == len(found[304].token_ids)
    assert 300 not in found


def test_empty_table(spark, folder, tmp_path):
    import corpus_pipeline as cp

    path, _, _ = folder
    spark.read.parquet(f"{path}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{path}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0
