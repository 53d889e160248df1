"""The whole pipeline against a chain of plain-Python stages, all columns of all rows."""

import hashlib
import random
from collections import Counter

from test_registry import _components
from test_text_operators import _hits, _quality, _tiktoken

import corpus_pipeline

RULES = [(3, 85), (5, 80)]  # words of a shingle, percent
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept int, spans string, hit int"


def _near(rows):
    """Rows of null ids all stay; of the others one for each component of different (doc_id, text)."""
    known = sorted({r for r in rows if r[0] is not None})
    return [r for r in rows if r[0] is None] + [known[k] for k in _components([t for _, t in known], RULES)]


def _cut(rows, width=200):
    """Texts without bytes covered by a string that starts twice, and without characters cut in two."""
    raws = [t.encode() for _, t in rows]
    seen = Counter(raw[k : k + width] for raw in raws for k in range(len(raw) - width + 1))
    out = []
    for (doc, _), raw in zip(rows, raws, strict=True):
        gone = set()
        for k in range(len(raw) - width + 1):
            if seen[raw[k : k + width]] > 1:
                gone.update(range(k, k + width))
        out.append((doc, bytes(b for k, b in enumerate(raw) if k not in gone).decode(errors="ignore")))
    return out


def _corpus():
    rng = random.Random(23)
    words = ["the", "of", "naïve", "x,", "Tail.", "10", "a|b", *(f"w{k}" for k in range(4000))]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, base, asked = text(70), text(240), text(16)
    rows = [(k, text(rng.randint(40, 300))) for k in range(20)]
    rows += [(100 + k, f"{text(90)} {passage}\n{text(90 + k)}") for k in range(6)]
    rows += [(200 + k, f"{text(30)} {asked} {text(30)}") for k in range(3)] + [(203, f"{text(300)} {asked} {text(300)}")]
    for k in range(6):  # linked in a row, by 3 words, by 5 words, then no more
        changed = base.split(" ")
        changed[20 : 20 + 9 * k] = ["changed"] * 9 * k
        rows.append((300 + k, " ".join(changed)))
    rows += [(400, None), (401, ""), (402, " \n\t"), (403, "one"), (404, "same words again " * 60)]
    rows += [rows[3], rows[3], (None, rows[5][1]), (None, rows[5][1]), (None, None), (7, text(120))]
    return rows, [("1", asked), ("2", None), ("3", ""), ("4", text(14))]


def _write(spark, folder, rows, items):
    docs = [(i, t, "en", "s", len(t or ""), 1, "x", 2) for i, t in rows]
    spark.createDataFrame(docs, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_run_equals_plain_stages(spark, tmp_path):
    rows, items = _corpus()
    _write(spark, tmp_path, rows, items)
    good = [(i, t) for i, t in rows if _quality(t)[6]]
    one = _near(good)
    cut = _cut(one)
    clean = [(i, t) for i, t in cut if not _hits(t, items)[4]]
    assert len(rows) > len(good) > len(one) > len(clean) and cut != one
    library = _tiktoken()
    expected = []
    for doc, text in clean:
        ids = library.encode_ordinary(text)
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        expected.append((doc, len(ids), digest, hashlib.sha256(text.encode()).hexdigest(), ids))
    found = corpus_pipeline.run(spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)


def test_run_of_no_documents(spark, tmp_path):
    _write(spark, tmp_path, [], [("1", "some words")])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
