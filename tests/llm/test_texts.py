"""HTML extraction, BPE, backoff scores and SimHash against brute force and their edge cases."""

import base64
import math
import random
import re
import time
import tracemalloc
import weakref
from collections import Counter
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from casebook.llm import backoff_lm, bpe, html_text, simhash, word_arrays

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


# -------------------------------------------------------------------------- html
@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<!-- only", ""), ("plain &amp; simple", "plain & simple"),
    ("<p>a<b>b</b> c<br>d<p>e", "ab c d e"),
    ("<body><nav><a href=x>Menu</a></nav><article><h1>Title</h1><p>Body&nbsp;&lt;text&gt;\n here.</p></article>"
     "<footer>foot</footer></body>", "Title Body <text> here."),
    ("<article><p>One.</p><div class='ad'>Buy</div><aside>Side</aside><p>Two.</p><form><input>Send</form>"
     "<div id='comments'><p>First!</p></div></article>", "One. Two."),
    ("<article><p title='a>b'>x</p><script>var t='</p>';</script><style>p{}</style><p>y</article>", "x y"),
    ("<div class=cookie-notice>We use cookies</div><div><p>Long text of the page that goes on.</p>"
     "<p>And some more of it.</p></div>", "Long text of the page that goes on. And some more of it."),
    ("<article><p><b>bold start<br><p>next</p></article><footer>f</footer>", "bold start next"),
    ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>", "a b c d"),
    ("<article><p>caf&eacute; &#233; &#x1F600; &unknown; &am</p></article>", "café é \U0001f600 &unknown; &am"),
])
def test_main_text(page, text):
    assert html_text.main_text(page) == text


PARAGRAPH = "Some words of a paragraph that goes on for a while, and on."
LINKS = "<div><ul>" + "<li><a href=x>Link text</a></li>" * 12 + "</ul></div>"


def _paragraphs(name, n=3):
    return "".join(f"<p>{name}{i}. {PARAGRAPH}</p>" for i in range(n))


@pytest.mark.parametrize("page, names", [
    (f"<body><div>{_paragraphs('a', 4)}</div>{LINKS}<div>{_paragraphs('b')}</div></body>", "a0 a1 a2 a3 b0 b1 b2"),
    (f"<body><div>{LINKS}<div>{_paragraphs('a', 4)}</div><div>{_paragraphs('b', 2)}</div><div>tiny</div></div></body>",
     "a0 a1 a2 a3 b0 b1"),
    (f"<body><div>{LINKS}</div>loose. {PARAGRAPH} {PARAGRAPH}<div>{_paragraphs('a', 6)}</div></body>", "loose a0 a1 a2 a3 a4 a5"),
    (f"<body><main><article>{_paragraphs('a')}</article>{LINKS}<article><section>{_paragraphs('b')}</section>"
     "<p>end.</p></article></main></body>", "a0 a1 a2 b0 b1 b2 end"),
    (f"<body><h1>title.</h1><div>{_paragraphs('a')}</div><h3>other.</h3><div>tiny</div></body>", "title a0 a1 a2"),
])
def test_blocks_off_the_path_are_held_by_the_threshold(page, names):
    text = html_text.main_text(page)
    assert [w[:-1] for w in text.replace(PARAGRAPH, " ").split() if w.endswith(".")] == names.split()
    assert "Link text" not in text and "tiny" not in text


@pytest.mark.parametrize("page, text", [
    *[(f"<body><div class='{c}'><article><p>One.</p></article><div class='ad'>Buy</div></div></body>", "One.") for c in (
        "page has-sidebar", "no-sidebar", "with-banner", "post share-enabled", "layout sidebar", "menu_open")],
    ("<body><div class='sidebar'><p>The text of the page.</p><p>More of it.</p></div><div class=ad>Buy</div></body>",
     "The text of the page. More of it."),
    ("<article><h2 id='discussion'>A</h2><section id='related-work'>B</section><section id='discussion'>C</section>"
     "<h3 id='social-impact'>D</h3><h3 id='alert'>E</h3><div id='alert-levels'>F</div></article>", "A B C D E F"),
    ("<body><article><p>Text.</p></article><ol class='comment-list'><li><article>A far longer comment.</article></ol>"
     "<div class='related_posts'><article>Teaser of another page.</article></div></body>", "Text."),
    ("<body><div id=Cookie_Banner>We use cookies</div><div class='x AD'>Buy</div><article>Text.</article></body>", "Text."),
])
def test_only_whole_tokens_name_an_area_and_none_silences_the_page(page, text):
    assert html_text.main_text(page) == text


def test_nothing_of_a_long_article_is_dropped(spark):
    words = [f"w{i}" for i in range(40_000)]
    page = "<body><nav><a>m</a></nav><article>" + "".join(f"<p>{w}</p>" for w in words) + "</article></body>"
    pages = spark.createDataFrame([(1, page, "mine"), (1, page, "mine"), (2, None, "x")], "page_id long, html string, text string")
    got = html_text.extract(pages).collect()
    assert sorted((r.page_id, len(r.text.split())) for r in got) == [(1, 40_000), (1, 40_000), (2, 0)]
    assert html_text.extract(pages.limit(0)).collect() == []


# --------------------------------------------------------------------------- bpe
TEXTS = ["", " ", "  a  b\n\n c ", "it's we'll I'd", "123 4567 ½ Ⅷ", "naïve café   x", "日本語テキスト", "\U0001f600‍\U0001f469",
         "<|endoftext|> <|im_start|>", "a" * 700, "é" * 500, "\x00\x1c\x1f \x85 \x1c a", "ab" * 300 + " " * 500 + "x", "x \n y  z\t w",
         "\r\n \r\n", "don't   stop--now!!! ...", "﻿bom", "the quick brown fox " * 2000]


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("test", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_are_those_of_the_public_library(reference):
    codec = bpe.codec(PATH, PATTERN)
    ids = codec.encode(TEXTS)
    for text, got in zip(TEXTS, ids, strict=True):
        assert got.tolist() == reference.encode_ordinary(text), text[:30]
    assert codec.decode(ids) == [t.encode() for t in TEXTS]
    rng = np.random.default_rng(3)
    for n in (2, 9, 60, 399, 401, 2000):
        word = "".join(rng.choice(list("etaoinshré"), n))
        assert codec.encode([word])[0].tolist() == reference.encode_ordinary(word)


def test_bpe_columns(spark, reference):
    rows = [(i, t, "x") for i, t in enumerate([*TEXTS, None, "the", "the"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    one = docs.select("doc_id", "text", bpe.round_trip(F.col("text"), PATH, PATTERN).alias("t")).collect()
    for r in one:
        assert r.t.ids == reference.encode_ordinary(r.text or "")
        assert bytes(r.t.decoded) == (r.text or "").encode()
    two = docs.select("doc_id", bpe.encode(F.col("text"), PATH, PATTERN).alias("i")).select(
        "doc_id", "i", bpe.decode(F.col("i"), PATH, PATTERN).alias("d")).collect()
    assert {r.doc_id: (r.i, bytes(r.d)) for r in two} == {r.doc_id: (r.t.ids, bytes(r.t.decoded)) for r in one}
    assert docs.limit(0).select(bpe.encode(F.col("text"), PATH, PATTERN)).collect() == []
    none = spark.createDataFrame([(None,)], "i array<int>").select(bpe.decode(F.col("i"), PATH, PATTERN).alias("d"))
    assert bytes(none.first().d) == b""


def test_small_kept_tables_change_nothing(reference, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 5)
    monkeypatch.setattr(bpe, "KEPT_PIECES", 5)
    monkeypatch.setattr(bpe, "QUERY_BYTES", 10)
    codec = bpe.Codec(PATH, PATTERN)
    for _ in range(2):
        assert [x.tolist() for x in codec.encode(TEXTS)] == [reference.encode_ordinary(t) for t in TEXTS]


def test_white_space_beside_blanks_does_not_depend_on_what_came_before(reference):
    codec = bpe.Codec(PATH, PATTERN)
    texts = ["a b c", "a b\n", "a b\n c", " b c", "  b  c ", "b ", " ", "", "a \x1cb c", "a b\x85 c", "a\u3000 b", "b\n c b\n", "x  b c  "]
    for batch in (texts, texts[::-1], *[[t] for t in texts]):  # pieces that are known, and that are not
        assert [x.tolist() for x in codec.encode(batch)] == [reference.encode_ordinary(t) for t in batch]


def test_known_words_are_kept_while_new_ones_fit(monkeypatch):
    codec = bpe.Codec(PATH, PATTERN)
    monkeypatch.setattr(bpe, "KEPT_WORDS", 4)
    codec.learn({"qzxv", "wkjq"})
    codec.learn({"qzxv", "wkjq", "vvkq"})  # three at most, though 2 + 3 > 4
    asked = []
    monkeypatch.setattr(codec, "_query", lambda todo: asked.extend(w for w, _ in todo))
    codec.learn({"qzxv", "wkjq", "vvkq"})
    assert asked == []


def test_a_batch_of_texts_asks_one_recursive_query(reference, monkeypatch):
    """Every pass of the query builds a table of all merges, so a batch of 3 MB asks it once, not once per MB."""
    asked = []
    ask = bpe.Codec._ask
    monkeypatch.setattr(bpe.Codec, "_ask", lambda self, sql, rows: asked.append(sql) or ask(self, sql, rows))
    codec = bpe.Codec(PATH, PATTERN)
    texts = ["the " * 50_000 + f"qzx{i}vvk" for i in range(15)]
    got = [x for group in bpe._text_groups(pa.array([*texts, None])) for x in codec.encode(group)]
    assert asked.count(bpe.ENCODE) == 1
    assert got[7].tolist() == reference.encode_ordinary(texts[7]) and len(got) == 16 and not len(got[15])


def test_pieces_of_a_batch_do_not_stand_together(reference):
    """A batch of 4 MB has some 700,000 pieces, 40 MB as strings; the texts fall apart a few at a time."""
    codec = bpe.Codec(PATH, PATTERN)
    texts = ["the quick brown fox " * 12_500] * 8 + ["a b  c d\n " * 25_000] * 8
    want = codec.encode(texts)
    tracemalloc.start()
    try:
        got = codec.encode(texts)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 25e6
    assert all(np.array_equal(a, b) for a, b in zip(got, want, strict=True))
    assert got[0].tolist() == reference.encode_ordinary(texts[0]) and got[8].tolist() == reference.encode_ordinary(texts[8])


def test_an_idle_worker_gives_its_tables_back(monkeypatch):
    """Idle workers stand beside other stages for a minute, or serve them."""
    bpe.codec.cache_clear()
    monkeypatch.setattr(bpe, "IDLE_SECONDS", 1.0)
    with bpe.codec_at_work(PATH, PATTERN) as first:
        first.encode(["qzxv wkjq"])
    with bpe.codec_at_work(PATH, PATTERN) as second:  # the next batch comes in time
        assert second is first and first.words
        time.sleep(1.5)  # a long batch keeps what it has
        assert bpe.codec(PATH, PATTERN) is first
    gone = weakref.ref(first)
    del first, second
    until = time.monotonic() + 30
    while gone() is not None and time.monotonic() < until:
        time.sleep(0.1)
    assert gone() is None and bpe.codec.cache_info().currsize == 0


def test_idle_workers_of_spark_give_their_tables_back(spark):
    @F.arrow_udf("int")
    def kept(x: pa.Array) -> pa.Array:
        from casebook.llm import bpe

        return pa.array([bpe.codec.cache_info().currsize] * len(x), pa.int32())

    docs = spark.range(8).repartition(4).select("id", F.lit("qzxv wkjq").alias("text"))
    assert docs.select(bpe.encode(F.col("text"), PATH, PATTERN).alias("i")).collect()
    time.sleep(bpe.IDLE_SECONDS + 2)
    assert {r.n for r in docs.select(kept("id").alias("n")).collect()} == {0}


def test_unknown_ids_raise():
    with pytest.raises(ValueError):
        bpe.codec(PATH, PATTERN).decode([np.array([1, 60_000], np.int32)])


# ----------------------------------------------------------------------- simhash
def brute_fingerprint(text, k):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


DOCS = [(1, "a b c d e f g"), (2, "A B c\td e\x0bf g "), (3, None), (4, ""), (5, " \n "), (6, "É b"), (7, "é b"), (8, "x"),
        (9, "a b c"), (10, "same words again and again"), (10, "same words again and again"), (None, "same words again and again")]


def test_fingerprints_and_components(spark):
    docs = spark.createDataFrame([(i, t, "c") for i, t in DOCS], "doc_id long, text string, fp string")
    got = simhash.components(docs).collect()
    assert len(got) == len(DOCS)
    want = Counter((i, f"{brute_fingerprint(t, 4):016x}") for i, t in DOCS)
    assert Counter((r.doc_id, r.fingerprint) for r in got) == want
    comp = {r.doc_id: r.component_id for r in got}
    assert comp[1] == comp[2] == 1 and comp[3] == comp[4] == comp[5] == 3 and comp[10] == comp[None] == 10
    assert simhash.components(docs.limit(0)).collect() == []


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("bits", [0, 1, 3, 4, 6])
def test_components_of_fingerprints_equal_brute_force(spark, bits):
    rng = np.random.default_rng(bits)
    base = [int(x) for x in rng.integers(0, 2**63, 40, dtype=np.uint64)]
    fps = set(base)
    for b in base:  # chains of flips: linked step by step, far apart at their ends
        for _ in range(12):
            for bit in rng.choice(64, rng.integers(1, bits + 2), replace=False):
                b ^= 1 << int(bit)
            fps.add(b)
    centre = int(rng.integers(0, 2**63))  # a dense group
    fps |= {centre ^ sum(1 << int(x) for x in rng.choice(64, 2, replace=False)) for _ in range(150)}
    u = np.array(sorted(fps), np.uint64)
    parent = list(range(len(u)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in zip(*np.nonzero(np.bitwise_count(u[:, None] ^ u[None, :]) <= bits), strict=True):
        a, b = find(int(a)), find(int(b))
        parent[max(a, b)] = min(a, b)
    groups = {}
    for i in range(len(u)):
        groups.setdefault(find(i), set()).add(_signed(int(u[i])))
    df = spark.createDataFrame([(_signed(int(x)),) for x in u], "fp long")
    found = {}
    for r in simhash.fingerprint_components(df, bits).collect():
        found.setdefault(r.label, set()).add(r.fp)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, groups.values()))


def test_one_document_of_each_group_stays(spark):
    docs = spark.createDataFrame([(i, t, f"s{n}") for n, (i, t) in enumerate(DOCS[:-3])] + [(10, "same words again and again", "z")] * 3
                                 + [(None, "same words again and again", "z"), (11, "same words again and again", "z")],
                                 "doc_id long, text string, source string").withColumn("label", F.lit(1))
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.collect())
    assert ids.count(10) == 1 and 1 in ids and 2 not in ids and 3 in ids and 4 not in ids and 11 not in ids
    assert simhash.deduplicated(docs.limit(0)).collect() == []


# ------------------------------------------------------------------------ backoff
def _brute_backoff(data, order, alpha, least):
    texts = [(i, [w for w in re.split(r"[\x20\x09-\x0D]+", (t or "").lower()) if w]) for i, t in data]
    counts = Counter(tuple(w[j:j + n]) for _, w in texts for n in range(1, order + 1) for j in range(len(w) - n + 1))
    total = sum(len(w) for _, w in texts)
    out = {}
    for i, w in texts:
        one = out.setdefault(i, [0, 0, 0.0])
        for j in range(len(w)):
            top = n = min(order, j + 1)
            while n > 1 and counts[tuple(w[j - n + 1:j + 1])] < least:
                n -= 1
            g = tuple(w[j - n + 1:j + 1])
            one[0] += 1
            one[1] += top - n
            one[2] += math.log(counts[g] / (counts[g[:-1]] if n > 1 else total)) + (top - n) * math.log(alpha)
    return out


@pytest.mark.parametrize("order, least, slices, hot", [(1, 2, 1, 100_000), (2, 2, 3, 4), (3, 2, 2, 100_000), (3, 1, 1, 8), (4, 3, 2, 5)])
def test_backoff_scores_equal_brute_force(spark, monkeypatch, order, least, slices, hot):
    rnd = random.Random(order)
    data = [(1, "the cat sat on the mat"), (2, "The cat sat"), (4, None), (5, ""), (6, "the the the the"), (6, "on the mat"),
            (None, "cat"), (None, "sat on\x0bthe\fmat"), (7, " ")]
    data += [(10 + k % 20, " ".join(rnd.choice("abcde") + "x" * rnd.randrange(2) for _ in range(rnd.randrange(40)))) for k in range(40)]
    docs = spark.createDataFrame([(i, t, 0) for i, t in data], "`doc.id` long, text string, key int").repartition(3)
    monkeypatch.setattr(backoff_lm, "HOT", hot)
    want = _brute_backoff(data, order, 0.4, least)
    got = backoff_lm.score(docs, "doc.id", order=order, min_count=least, slices=slices).collect()
    assert len(got) == len(want)
    for r in got:
        n, steps, score = want[r.doc_id]
        assert (r.n_words, r.n_backoff) == (n, steps)
        assert (r.log_score is None) == (r.mean_log_score is None) == (n == 0)
        assert n == 0 or r.log_score == pytest.approx(score)


def test_backoff_of_no_rows(spark):
    assert backoff_lm.score(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_hot_ids_are_found_where_they_are():
    rnd = np.random.default_rng(3)
    ids = np.unique(np.concatenate([rnd.integers(0, 2**64, 400, dtype=np.uint64), np.arange(40, dtype=np.uint64), [np.uint64(2**64 - 1)]]))
    rows = rnd.permutation(len(ids))
    hot = backoff_lm.Hot.of(pa.table({"id": ids[rows].view(np.int64), "n": rows}), "n")
    asked = np.concatenate([ids, rnd.integers(0, 2**64, 400, dtype=np.uint64), np.arange(40, 80, dtype=np.uint64)])
    at = hot.find(asked)
    assert (at[:len(ids)] == np.arange(len(ids))).all() and (hot.columns[0] == np.arange(len(ids))).all()
    assert (at[len(ids):] == -1).all()
    none = backoff_lm.Hot.of(pa.table({"id": pa.array([], pa.int64())}))
    assert (none.find(asked) == -1).all() and len(hot.find(ids[:0])) == 0


def test_hot_parts_of_ngrams_need_no_join():
    hot = backoff_lm.Hot.of(pa.table({"id": [1, 2], "n": [8, 4], "back_n": [100, 100]}), "n", "back_n")
    packed = pa.table({
        "front": [np.array([1, 1, 9], np.uint64).tobytes(), np.array([1, 2], np.uint64).tobytes()],
        "back": [np.array([2, 9, 2], np.uint64).tobytes(), np.array([2, 1], np.uint64).tobytes()],
        "n": [np.array([1, 2, 2], np.int32).tobytes(), np.array([1, 1], np.int32).tobytes()]})
    got = backoff_lm._summed(2, 2, 2, SimpleNamespace(value=hot), math.log(0.4))(packed).to_pylist()
    assert [(r["front"], r["back"], r["n"], r["back_n"]) for r in sorted(got, key=lambda r: (r["front"] or 0, r["back"] or 0))] == [
        (None, None, 2, 4), (None, 9, 2, 0), (9, None, 2, 4)]
    assert {(r["front"], r["back"]): r["value"] for r in got} == pytest.approx({
        (None, None): math.log(2 / 8 / (4 / 100) / 0.4), (None, 9): math.log(2 / 8 * 100 / 0.4), (9, None): math.log(2 / 4 / 0.4)})


def test_backoff_reads_the_texts_once_per_order_and_slice(spark, monkeypatch):
    passes = Counter()
    for name in ("_count", "_send"):
        def made(*args, name=name, whole=getattr(backoff_lm, name)):
            passes[name] += 1
            return whole(*args)

        monkeypatch.setattr(backoff_lm, name, made)
    docs = spark.createDataFrame([(1, "a b c a b c"), (2, "a b")], "doc_id long, text string")
    assert {r.doc_id: r.n_words for r in backoff_lm.score(docs, slices=2).collect()} == {1: 6, 2: 2}
    assert passes == {"_count": 3, "_send": 2}


def test_words_hash_alike_wherever_they_stand():
    rnd = random.Random(5)
    words = [*{"".join(rnd.choice("ab\0é") for _ in range(n)) for n in (*range(1, 40), 127, 128, 129, 300, 70_000) for _ in range(5)}]
    texts = [" ".join(rnd.sample(words, len(words))), "", None, *words[:9], "  ".join(words)]
    got = word_arrays.cut(pa.array(texts), word_arrays.classes(" \n"))
    said = [bytes(got.raw[a:b]) for a, b in zip(got.starts, got.ends, strict=True)]
    assert said == [w.encode() for t in texts for w in (t or "").split(" ") if w]
    assert len(set(zip(said, got.hashes.tolist(), strict=True))) == len(set(said)) == len(set(got.hashes.tolist()))
    assert got.text.tolist() == [k for k, t in enumerate(texts) for w in (t or "").split(" ") if w]


def test_bit_table_holds_its_ids():
    rnd = np.random.default_rng(1)
    ids, others = rnd.integers(0, 2**63, 500, dtype=np.uint64), rnd.integers(0, 2**63, 500, dtype=np.uint64)
    bits = np.zeros(1 << 12, np.uint8)
    place = (ids & np.uint64((1 << 15) - 1)).astype(np.int64)
    np.bitwise_or.at(bits, place >> 3, (1 << (place & 7)).astype(np.uint8))
    assert backoff_lm._has(bits, ids).all()
    assert backoff_lm._has(bits, others).mean() < 0.1


# ------------------------------------------------------------------------ main text, round three
def test_pages_without_article_give_the_text_of_those_with_it():
    pages = pq.read_table("/root/testdata/sf0.01/pages.parquet", columns=["html"])["html"].to_pylist()
    for page in pages:
        bare = re.sub(r"<(/?)(article|main)\b", r"<\1div", page)
        assert html_text.main_text(page) == html_text.main_text(bare)


@pytest.mark.parametrize("name", ["comments-list", "comment-12", "user_comments", "advert-box", "ad-unit", "top-ad", "left-sidebar", "cookie-bar-2"])
@pytest.mark.parametrize("attribute", ["class", "id"])
def test_compounds_name_areas(name, attribute):
    area = f"<div {attribute}='{name}'><p>Stray words that are long enough to look like text of the page.</p></div>"
    for page in (f"<body><article>{_paragraphs('a', 4)}</article>{area}</body>", f"<body><article>{_paragraphs('a', 4)}{area}</article></body>",
                 f"<body><div>{_paragraphs('a', 4)}{area}</div></body>"):
        text = html_text.main_text(page)
        assert "Stray" not in text and "a3" in text


@pytest.mark.parametrize("name", ["page has-sidebar", "no-sidebar", "with-comments", "post share-enabled", "ad-hoc", "related-work", "discussion"])
def test_names_that_only_tell_of_areas_silence_nothing(name):
    text = html_text.main_text(f"<body><div class='{name}'>{_paragraphs('a', 4)}</div>{LINKS}</body>")
    assert "a0" in text and "a3" in text
    inside = html_text.main_text(f"<body><article>{_paragraphs('a', 2)}<section id='{name.split()[-1]}'>{_paragraphs('b', 2)}</section></article></body>")
    assert "b0" in inside


@pytest.mark.parametrize("page", ["<b>x</i>" * 60_000, "<p><table>" + "<b>" * 40_000 + "<hr>" * 40_000, "<li>" * 50_000 + "</ul>" * 50_000,
                                  "<div>" * 30_000 + "x" + "</span>" * 30_000])
def test_broken_tags_take_linear_time(page):
    began = time.process_time()
    html_text.main_text(page)
    assert time.process_time() - began < 8  # quadratic closing took minutes


def test_pages_with_odd_columns(spark):
    pages = spark.createDataFrame([(1, "<p>x y</p>", "u")], "`page.id` long, `ht.ml` string, text string")
    out = html_text.extract(pages, html="ht.ml")
    assert out.columns == ["page.id", "text"] and tuple(out.first()) == (1, "x y")


# ------------------------------------------------------------------------ near-duplicates with odd columns
ODD = """id AS doc_id, t AS text, concat('s', id % 2) AS `a.b`, map('k', t, 'l', 'm') AS m, parse_json(concat('{"v":', id, '}')) AS v,
         array(map(coalesce(id, -1), t)) AS nested, named_struct('x.y', id) AS `doc_id.s`, CAST(NULL AS STRING) AS fp, id AS h, 1 AS label"""


def test_deduplicated_with_any_column(spark):
    base = " ".join(f"w{i}" for i in range(80))
    rows = [(1, base), (2, base), (2, base), (3, base + " more"), (4, "other words entirely " * 20), (5, None), (None, None)]
    spark.createDataFrame(rows, "id long, t string").createOrReplaceTempView("odd_rows")
    docs = spark.sql(f"SELECT {ODD} FROM odd_rows")
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns
    got = sorted(kept.selectExpr("doc_id", "to_json(struct(m, v, nested)) AS j", "`a.b`").collect(), key=str)
    want = {r.doc_id: (r.j, r["a.b"]) for r in docs.selectExpr("doc_id", "to_json(struct(m, v, nested)) AS j", "`a.b`").collect()}
    component = {r.doc_id: r.component_id for r in simhash.components(docs).collect()}
    assert {r.doc_id for r in got} == set(component.values()) and len(got) == len(set(component.values()))
    assert all((r.j, r["a.b"]) == want[r.doc_id] for r in got)
    import corpus_pipeline

    stage = dict(corpus_pipeline.STAGES)["SimHash near-dedup"]
    assert sorted(r.doc_id for r in stage(spark, docs, "").select("doc_id").collect()) == sorted(r.doc_id for r in got)


def test_components_of_a_dense_group_equal_brute_force(spark):
    rnd = random.Random(2)
    centre = rnd.getrandbits(64)
    fps = {centre}
    while len(fps) < 400:  # a chain of close fingerprints that share segments, and loners
        near = rnd.choice(sorted(fps))
        for _ in range(rnd.randint(1, 3)):
            near ^= 1 << rnd.randrange(64)
        fps.add(near if rnd.random() < 0.8 else rnd.getrandbits(64))
    fps = sorted(fps)
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                parent[root(i)] = root(j)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    rows = spark.createDataFrame([(x,) for x in signed], "fp long")
    label = {r.fp: r.label for r in simhash.fingerprint_components(rows, 4).collect()}
    assert len(label) == len(fps)
    groups = {}
    for i, x in enumerate(signed):
        groups.setdefault(root(i), set()).add(label[x])
    assert all(len(g) == 1 for g in groups.values()) and len({min(g) for g in groups.values()}) == len(groups)
