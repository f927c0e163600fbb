"""The pipeline stage by stage, each against a plain version of its decision on the stage's own input."""

import random
import re

import pytest

import corpus_pipeline
from paydw.llm import piece_lattice
from paydw.llm.common import cut
from test_operators import SCHEMA, distance, lorem, shingles

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    """Input and output rows of every stage on a small corpus with copies, repeated lines and odd texts."""
    rng = random.Random(21)
    real = spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()
    rows = [(r.doc_id, r.text[:1500], r.lang, r.source, len(r.text[:1500])) for r in real]
    base = [lorem(rng, 60) for _ in range(5)]
    for i in range(40):
        words = rng.choice(base).split()
        words[rng.randrange(len(words))] = rng.choice(["new", "old"])
        rows.append((1000 + i, "\n".join([" ".join(words[:30]), "a line that many documents repeat", " ".join(words[30:])]),
                     "en", rng.choice(["x", None]), 0))
    rows += [(2000, None, None, "x", None), (2001, "", "en", "x", 0), (2002, "12 34", "en", "x", 5), (None, "der Hund und die Katze", "de", "x", 22)]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = [docs.collect()]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = cut(stage(spark, docs, SF), name)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == [f.split()[0] for f in SCHEMA.split(", ")]
        out.append(docs.collect())
    return out


def test_language_stage_drops_texts_without_letters(kept):
    before, after = kept[0], kept[1]
    ids = {r.doc_id for r in after}
    assert {2000, 2001, 2002}.isdisjoint(ids) and {r.doc_id for r in before if 1000 <= (r.doc_id or 0) < 2000} <= ids
    assert {tuple(r) for r in after} <= {tuple(r) for r in before}


def test_language_stage_without_labels_drops_only_texts_without_letters(spark):
    rows = [(1, "der Hund", None, "x", 8), (2, "12 34", None, "x", 5), (3, None, None, "x", None), (None, "a", None, "x", 1)]
    out = corpus_pipeline.identify(spark, spark.createDataFrame(rows, SCHEMA), SF)
    assert {r.doc_id for r in out.collect()} == {1, None} and out.columns == [f.split()[0] for f in SCHEMA.split(", ")]


def test_line_stage(kept):
    seen, want = [], {}
    for r in sorted(kept[1], key=lambda r: (r.doc_id is not None, r.doc_id)):
        lines = []
        for line in r.text.split("\n"):
            if len(line) >= 20:
                if any(abs(len(x) - len(line)) <= 2 and (x == line or distance(x, line) <= 2) for x in seen):
                    seen.append(line)
                    continue
                seen.append(line)
            lines.append(line)
        want[r.doc_id] = "\n".join(lines)
    assert {r.doc_id: r.text for r in kept[2]} == want and all(r.n_chars == len(r.text) for r in kept[2])


def test_copy_stage_keeps_one_of_each_group(kept):
    rows = [r for r in kept[2] if r.doc_id is not None]
    label = {r.doc_id: r.doc_id for r in rows}
    sets = {r.doc_id: shingles(r.text, 5) for r in rows}
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both) and label[a] != label[b]:
                x, y = sorted((label[a], label[b]))
                label = {k: x if v == y else v for k, v in label.items()}
    assert sorted(r.doc_id for r in kept[3] if r.doc_id is not None) == sorted(set(label.values()))


def test_mix_stage_takes_words_of_its_documents(kept):
    before = {r.doc_id: r.text.split() for r in kept[3]}
    for r in kept[4]:
        words = r.text.split()
        assert words and set(words) <= set(before[r.doc_id]) and r.n_chars == len(r.text)
    taken = {}
    for r in kept[4]:
        taken[r.doc_id] = taken.get(r.doc_id, 0) + len(r.text.split())
    assert all(n <= 2 * len(before[i]) for i, n in taken.items())
    assert abs(sum(taken.values()) - 1.5 * sum(map(len, before.values()))) < 400


def test_encoding_stage_round_trips(kept):
    assert sorted(r.text for r in kept[5]) == sorted(re.sub("▁", " ", r.text) for r in kept[4])
    assert all(len(r.ids) == r.n_pieces > 0 for r in kept[5])


def test_run_is_all_stages(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and {"doc_id", "ids", "text"} <= set(out.columns)


def test_stage_names_and_operators():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "ngram_join", "source_mix", "piece_lattice"]
    assert piece_lattice.encode is not None


def test_stages_keep_columns_named_as_their_own(spark):
    """Extra columns named like the operators' own, and an empty table, go through every stage."""
    rng = random.Random(22)
    names = ("_text", "_letter", "lang_pred", "score", "_dropped", "row", "gone", "some")
    rows = [(i, lorem(rng, 30) + "\na line that many documents repeat", "en", "x", 0, *names) for i in range(30)]
    schema = SCHEMA + "".join(f", {n} string" for n in names)
    for rows_in in (rows, []):
        docs = spark.createDataFrame(rows_in, schema)
        for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
            docs = cut(stage(spark, docs, SF), name)
            if i < len(corpus_pipeline.STAGES) - 1:
                assert docs.columns == [f.split()[0] for f in schema.split(", ")], name
                assert all(tuple(r)[5:] == names for r in docs.collect()), name
        assert (docs.count() > 0) == bool(rows_in)
