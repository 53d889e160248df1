"""Operators 1, 3, 4, 6, 7, 9 and 10 against brute force, libraries and round trips."""

import base64
import collections
import hashlib
import random
import time
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from tokenizers import Tokenizer

from matchboard.llm import (
    decontamination,
    html_text,
    kernel,
    merge_replay,
    packed_tokens,
    pieces,
    quality_rules,
    token_counts,
    zstd_quality,
)

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _ordered(rows):
    return sorted(rows, key=repr)


# operator 1


def _quality(text, rules=quality_rules.Rules()):
    text = text or ""
    words = WORD.findall(text)
    n = len(words)

    def covered(width):
        seen = collections.Counter(tuple(words[k : k + width]) for k in range(n - width + 1))
        mask = [False] * n
        for k in range(n - width + 1):
            if seen[tuple(words[k : k + width])] > 1:
                mask[k : k + width] = [True] * width
        return sum(mask)

    lines, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in lines
            lines.add(line)
    low, high = 0, max(n - 1, 0)  # longest repeat by bisection: shorter repeats exist wherever longer ones do
    while low < high:
        middle = (low + high + 1) // 2
        if covered(middle):
            low = middle
        else:
            high = middle - 1
    triples, part = covered(3), covered(rules.min_repeat)
    failed = n < rules.min_words or 100 * triples > rules.max_repeat_words_pct * n
    good = 100 * part <= rules.max_covered_pct * n and low <= rules.max_longest
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return (n, sum(map(len, words)), symbols, again, triples, failed, not failed and good, part, low)


def test_quality_rules(odd_docs, odd_rows, rows):
    assert rows(quality_rules.quality_rules(odd_docs)) == _ordered((i, *_quality(t)) for i, t in odd_rows)


def test_quality_limits(docs, corpus):
    rules = quality_rules.Rules(min_words=5, max_repeat_words_pct=100, min_repeat=2, max_covered_pct=60, max_longest=20)
    found = {r.doc_id: r.kept for r in quality_rules.quality_rules(docs, rules).collect()}
    assert found == {i: _quality(t, rules)[6] for i, t in corpus}
    assert 0 < sum(found.values()) < len(found)


def test_good_documents_keep_their_columns(docs, corpus):
    good = quality_rules.good_documents(docs.selectExpr("*", "1 kept", "2 n_words"))
    assert {r.doc_id for r in good.collect()} == {i for i, t in corpus if _quality(t)[6]}
    assert good.columns == [*docs.columns, "kept", "n_words"]


# operator 3

PAGE = """<!DOCTYPE html><html><head><title>no</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav><div id="cookie-notice">We use cookies, lots and
lots of cookies, and this line is long enough to look like text.</div><main><article><h1>A &amp; B</h1>
<p>First   paragraph&nbsp;with <b>bold</b> and a <a href="x">link</a>, and quite some text in it.<p>Short.<br>Two
<ul><li>one<li>two</ul></article><section class="comments"><p>A reader says a lot of things here as well.</p></section></main>
<aside>Other</aside><form><input><label>Name</label></form><div class="ad">Buy</div><footer>&copy; x</footer></body></html>"""


def test_main_text():
    assert html_text.main_text(PAGE) == (
        "A & B\n\nFirst paragraph with bold and a link, and quite some text in it.\n\nShort. Two\n\none\n\ntwo"
    )
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<p></p>") == ""
    assert html_text.main_text("plain &lt;text&gt;") == "plain <text>"
    assert html_text.main_text("<p>a</div></p></p><b>b") == "a\n\nb"
    assert html_text.main_text("<body><p>" + "word " * 50_000 + "<p>x") == ("word " * 50_000).strip() + "\n\nx"


def _sentences(name, count):
    return [f"{name} sentence {k} says enough to be taken for the text of a page by its ratio." for k in range(count)]


def _paragraphs(lines):
    return "".join(f"<p>{line}</p>" for line in lines)


@pytest.mark.parametrize("tag", ["div", "section", "article"])
def test_main_text_of_siblings_around_a_table(tag):
    """All clusters count, and what lies between them; links before and after do not."""
    one, two = _sentences("first", 8), _sentences("second", 7)
    cells = [f"r{k}" for k in range(10)]
    table = "<table>" + "".join(f"<tr><td>{c}</td></tr>" for c in cells) + "</table>"
    links = "".join(f'<div><a href="{k}">l{k}</a></div>' for k in range(12))
    html = f"<body>{links}<{tag}>{_paragraphs(one)}</{tag}>{table}<{tag}>{_paragraphs(two)}</{tag}>{links}</body>"
    kept = html_text.main_text(html).split("\n\n")
    assert [x for x in kept if not x.startswith("l")] == [*one, *cells, *two]
    assert len([x for x in kept if x.startswith("l")]) <= 6  # those the smoothing reaches


def test_main_text_without_an_article_depends_on_the_ratios():
    text = _sentences("only", 6)
    menu = "".join(f'<div><a href="x">go {k}</a></div>' for k in range(30))
    html = f"<body>{menu}<div><h2>Title</h2>{_paragraphs(text)}</div>{menu}</body>"
    kept = html_text.main_text(html).split("\n\n")
    assert [x for x in kept if not x.startswith("go")] == ["Title", *text]
    assert len([x for x in kept if x.startswith("go")]) <= 6  # of 60
    # the article with little text gives way to the region with more
    html = f"<body><article><p>go</p></article><div>{_paragraphs(text)}</div></body>"
    assert all(line in html_text.main_text(html) for line in text)


def test_class_words_do_not_judge_inside_an_article():
    text = _sentences("some", 3)
    html = (
        f'<body><article><header><h1>Head</h1></header><div class="article-header">{_paragraphs(text[:1])}</div>'
        f'<div class="related-work">{_paragraphs(text[1:2])}</div>{_paragraphs(text[2:])}'
        f'<div class="comments">{_paragraphs(_sentences("reader", 3))}</div></article>'
        f'<div class="cookie-notice">{_paragraphs(_sentences("cookie", 5))}</div></body>'
    )
    assert html_text.main_text(html) == "\n\n".join(["Head", *text])


def test_unclosed_tags_take_linear_time():
    def seconds(count):
        html = "".join(f"<div><b>text {k} " for k in range(count)) + "</i>" * count
        start = time.perf_counter()
        assert html_text.main_text(html).count("\n\n") == count - 1
        return time.perf_counter() - start

    seconds(1000)
    assert seconds(48_000) < 20 * max(seconds(6000), 0.05)  # a page of about 1 MB


def test_pages(spark):
    data = [(1, "u", PAGE), (None, None, None), (1, "u", PAGE), (2, "v", "")]
    pages = spark.createDataFrame(data, "page_id bigint, url string, html string").selectExpr("*", "'x' text", "1 n_chars")
    found = _ordered(tuple(r) for r in html_text.extract_main_text(pages).collect())
    text = html_text.main_text(PAGE)
    assert found == _ordered([(1, "u", text, len(text))] * 2 + [(None, None, "", 0), (2, "v", "", 0)])
    assert html_text.extract_main_text(pages.limit(0)).count() == 0


# operator 4


@pytest.mark.parametrize("width", [1, 3, 8, 13, 16, 17, 32])
def test_bit_packing(width):
    ids = np.random.default_rng(width).integers(0, 1 << width, 1001, dtype=np.uint32)
    packed = packed_tokens.pack(ids, width)
    assert len(packed) == (1001 * width + 7) // 8
    assert (packed_tokens.unpack(packed, width, 0, 1001) == ids).all()
    assert (packed_tokens.unpack(packed, width, 37, 55) == ids[37:92]).all()
    assert packed_tokens.unpack(packed, width, 1001, 0).tolist() == []


def test_width():
    assert [packed_tokens.bits_for(n) for n in (1, 2, 3, 256, 257, 50_257)] == [1, 1, 2, 8, 9, 16]
    with pytest.raises(ValueError):
        packed_tokens.pack(np.array([8]), 3)


def _library_ids(texts):
    tokenizer = Tokenizer.from_file(JSON)
    return [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_packed_files(spark, docs, corpus, tmp_path):
    path = str(tmp_path / "packed")
    packed_tokens.write_packed(docs, path, JSON, block_ids=500)
    found = _ordered(tuple(r) for r in packed_tokens.read_digests(spark, path).collect())
    expected, start = [], 0
    for (i, _), ids in zip(corpus, _library_ids([t or "" for _, t in corpus]), strict=True):
        raw = np.array([*ids, 0], dtype="<u4").tobytes()
        expected.append((i, start, len(ids) + 1, zlib.crc32(raw)))
        start += len(ids) + 1
    assert found == _ordered(expected)
    (row,) = packed_tokens.read_document(spark, path, 20).collect()
    assert row.ids == [*_library_ids([corpus[20][1]])[0], 0]


def test_packed_odd_rows(odd_docs, odd_rows, empty_docs):
    found = packed_tokens.token_digests(odd_docs, JSON).collect()
    assert len(found) == len(odd_rows)
    ends = sorted((r.start, r.start + r.n_tokens) for r in found)
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:], strict=False))
    assert packed_tokens.token_digests(empty_docs, JSON).count() == 0


# operators 4 and 10: chunks


def _strings(count):
    rng = random.Random(4)
    letters = "ab  \n\t 's don't 12éñß漢字😀.,!?--__\r\n   x"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(count)]
    return [*texts, "a" * 5000, "  ", " ", "   x", "\n\n a", "x \n y", "Ġ .", " word, word. ,"]


def test_chunks_join_to_the_text():
    for text in _strings(500):
        assert "".join(pieces.chunks(text)) == text


def test_chunks_encode_like_the_text():
    texts = _strings(500)
    found = [np.frombuffer(raw, "<u4").tolist() for raw in packed_tokens._encode(texts, JSON)]
    assert found == _library_ids(texts)


def test_added_tokens_encode_like_the_library():
    name = "<|endoftext|>"
    texts = [name.join(part) for part in zip(_strings(200), _strings(300)[100:], strict=False)]
    texts += [name, name * 3, f" {name} ", f"a{name}b", f"a  {name}\n\n{name[:-1]}", name[1:]]
    found = [np.frombuffer(raw, "<u4").tolist() for raw in packed_tokens._encode(texts, JSON)]
    assert found == _library_ids(texts)


def test_memory_stays_bounded(monkeypatch):
    monkeypatch.setattr(pieces, "LIMIT", 3)
    memory = pieces.Memory(lambda new: [c.upper() for c in new])
    for k in range(50):
        words = [f"w{k}", f"w{k // 2}", "x" * 100]
        known = memory.look_up([words])
        assert [known[w] for w in words] == [w.upper() for w in words]
        assert len(memory.known) + len(memory.older) <= 12


# operator 10


def _tiktoken():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_merge_replay_matches_library():
    texts, library = _strings(1500), _tiktoken()
    found = merge_replay.encode_texts(texts, RANKS, public_tokenizers.PATTERN)
    assert found == [library.encode_ordinary(t) for t in texts]
    for text, ids in zip(texts, found, strict=True):
        assert merge_replay.decode_ids(ids, RANKS, public_tokenizers.PATTERN) == text.encode()


def test_bpe_digests(odd_docs, odd_rows, rows):
    library = _tiktoken()
    expected = []
    for i, text in odd_rows:
        ids = library.encode_ordinary(text or "")
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        expected.append((i, len(ids), digest, hashlib.sha256((text or "").encode()).hexdigest()))
    found = merge_replay.bpe_digests(odd_docs, RANKS, public_tokenizers.PATTERN)
    assert rows(found) == _ordered(expected)


def test_bpe_round_trip(docs, corpus):
    coded = merge_replay.bpe_encode(docs, RANKS, public_tokenizers.PATTERN)
    texts = merge_replay.decode_documents(coded, RANKS, public_tokenizers.PATTERN)
    assert {r.doc_id: r.text for r in texts.collect()} == {i: t or "" for i, t in corpus}


# operator 9


def _greedy(word, start, more):
    at, count, vocabulary = 0, 0, start
    while at < len(word):
        for end in range(len(word), at, -1):
            if word[at:end] in vocabulary:
                break
        else:
            return -1
        at, count, vocabulary = end, count + 1, more
    return count


def test_longest_match_of_random_vocabularies():
    rng = random.Random(5)

    def some(count, letters):
        return ["".join(rng.choice(letters) for _ in range(rng.randint(1, 5))).encode() for _ in range(count)]

    for _ in range(300):
        letters = rng.choice(("ab", "abc"))
        start, more = some(rng.randint(1, 8), letters), some(rng.randint(1, 8), letters)
        words = [b"", *some(6, letters * 3), b"abab" * 5]
        found = token_counts.LongestMatch(start, more).counts(words).tolist()
        assert found == [_greedy(w, set(start), set(more)) for w in words]


def test_token_counts(odd_docs, odd_rows, rows):
    ranks = merge_replay.read_ranks(RANKS)
    start, more = ({t for t in ranks if (t[0] == 32) == first} for first in (True, False))
    expected = []
    for i, text in odd_rows:
        words = (text or "").encode().split()
        expected.append((i, len(words), sum(_greedy(b" " + w, start, more) for w in words)))
    assert rows(token_counts.token_counts(odd_docs, RANKS)) == _ordered(expected)


# operator 6


def _hits(text, items):
    def split(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))

    words, hit, found = split(text), set(), set()
    for item, t in items:
        w = split(t)
        width = min(13, len(w))
        windows = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if w else set()
        for k in range(len(words) - width + 1) if w else ():
            if tuple(words[k : k + width]) in windows:
                hit.update(range(k, k + width))
                found.add(str(item))
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(words), len(hit), len(found), digest, len(hit) > 0 and 20 * len(hit) >= len(words)


def test_contamination(spark, odd_docs, odd_rows, rows, empty_docs):
    words = (odd_rows[30][1] or "").split()
    items = [(1, " ".join(words[:20])), (2, None), (3, ""), (10, "ONE, two!"), (11, " ".join(words[3:17])), (10, "É naïve")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    expected = _ordered((i, *_hits(t, items)) for i, t in odd_rows)
    found = decontamination.contamination(odd_docs, benchmark).drop("text_hash", "hit")
    assert any(row[3] for row in expected) and rows(found) == expected
    assert decontamination.contamination(empty_docs, benchmark).count() == 0
    none = decontamination.contamination(odd_docs, benchmark.limit(0))
    assert none.count() == len(odd_rows) and none.where("contaminated or n_hit > 0").count() == 0


def test_contamination_without_broadcast(spark, docs, corpus, rows, monkeypatch):
    monkeypatch.setattr(decontamination, "BROADCAST_WINDOWS", 0)
    items = [(1, corpus[20][1]), (2, "one two")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontamination.contamination(docs, benchmark).drop("text_hash", "hit")
    assert rows(found) == _ordered((i, *_hits(t, items)) for i, t in corpus)


def test_decontaminate(spark, odd_docs, odd_rows):
    items = [(1, odd_rows[20][1]), (2, "one two")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    clean = decontamination.decontaminate(odd_docs.selectExpr("*", "1 hit", "2 words"), benchmark)
    assert clean.columns == [*odd_docs.columns, "hit", "words"]
    assert _ordered(r.doc_id for r in clean.collect()) == _ordered(i for i, t in odd_rows if not _hits(t, items)[4])
    spans = decontamination.decontaminate(odd_docs, benchmark, remove="spans")
    texts = collections.Counter((r.doc_id, r.text) for r in spans.collect())
    for i, t in odd_rows:
        if not _hits(t, items)[1]:
            assert texts[i, t]
    assert texts[4, ""] == 1
    with pytest.raises(ValueError):
        decontamination.decontaminate(odd_docs, benchmark, remove="words")


# operator 7


def test_quality_score_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scores = zstd_quality.quality_scores(docs, labels)
    assert scores.count() == docs.count()
    known = scores.join(labels, "doc_id").where("held_out").collect()
    good = [r.score for r in known if r.quality == 1]
    bad = [r.score for r in known if r.quality == 0]
    wins = sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))
    assert wins > 0.9
    assert sum(r.predicted == r.quality for r in known) / len(known) > 0.9


def test_scores_of_odd_rows(spark, odd_docs, odd_rows, empty_docs):
    labels = spark.createDataFrame(
        [(k, k % 2, 0) for k in range(12, 50)] + [(None, 1, 0), (13, None, 0), (900, 1, 0)],
        "doc_id bigint, quality int, toxic int",
    )
    found = zstd_quality.quality_scores(odd_docs, labels).collect()
    assert len(found) == len(odd_rows) and all(0 <= r.score <= 1 for r in found)
    for r in found:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.predicted == (r.score >= 0.3)
    assert zstd_quality.quality_scores(empty_docs, labels).count() == 0
    unknown = zstd_quality.quality_scores(odd_docs, labels.limit(0)).select("score").distinct().collect()
    assert [r.score for r in unknown] == [0.5]


def test_training_sample_is_bounded(spark, docs):
    labels = spark.createDataFrame([(k, 1, 0) for k in range(70)], "doc_id bigint, quality int, toxic int")
    few = zstd_quality.training_rows(docs.union(docs), labels, zstd_quality.Settings(per_label=3))
    assert len(few) <= 6 and all(label == 1 for label, _ in few)


def test_matches_of_chunks_are_cut_in_a_row():
    """One cut for all chunks that begin with a space, with the matches of each cut alone."""
    calls = []

    def split(text):
        calls.append(text)
        return regex.findall(public_tokenizers.PATTERN, text)

    new = [" a", "b", " it's", "\n", " x,", "  y", " ", " 12abé", " z ", " 'll"]
    found, bounds = merge_replay._cut_matches(new, split)
    cut = [found[a:b] for a, b in zip(bounds, bounds[1:])]
    assert cut == [regex.findall(public_tokenizers.PATTERN, c) for c in new]
    assert len(calls) == 5
    letters = regex.compile("[a-z]+").findall  # leaves characters out
    found, bounds = merge_replay._cut_matches(new, letters)
    assert [found[a:b] for a, b in zip(bounds, bounds[1:])] == [letters(c) for c in new]


def test_worker_keeps_no_chunks_after_its_task():
    """What a task has encoded does not stay in a worker that other stages use again."""
    merge_replay.encode_texts(["some words of a task"], RANKS, public_tokenizers.PATTERN)
    assert not any(isinstance(x, pieces.Memory) for kept in merge_replay._loaded.values() for x in kept)


def test_tables_for_slices_are_small():
    """Arrays that every worker keeps beside its heap follow the slice."""
    assert kernel.powers(3, 1).nbytes <= 1 << 21


def test_zero_characters_encode_like_the_library():
    """Chunks are cut at a zero character, which a text may hold itself."""
    texts = ["a, b, c! été; d?! 1,2 x\0 y\0\nz", " a\0 ", "\0"]
    found = [np.frombuffer(raw, "<u4").tolist() for raw in packed_tokens._encode(texts, JSON)]
    assert found == _library_ids(texts)
    for text in texts:
        assert "".join(pieces.chunks(text)) == text
