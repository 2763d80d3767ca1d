"""Each text operator against a plain version, and on untidy rows: nulls, empty and long texts, repeats, empty tables, other columns."""

import base64
import collections
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import regex
from pyspark.sql import functions as F

from zonepulse.llm import arrays, decontaminate, fingerprints, main_text, near_dup, pieces, preferences, repeats, toxicity, warc, wavelet
from zonepulse.llm.bpe import encode_texts
from zonepulse.llm.near_dup import near_duplicates
from zonepulse.llm.queries import QUERIES
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
EXTRA = "doc_id long, text string, lang string, source string, n_chars long, id long, key string, part string, score string, spans string"


def frame(spark, texts, ids=None):
    """Documents with columns that clash with names inside the operators."""
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, None, "s", len(t or ""), 7, "k", "p", "x", "y") for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, EXTRA).repartition(3)


def words(rng, n, alphabet="abcdefghij"):
    return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def messy():
    rng = random.Random(5)
    base = [words(rng, 60) for _ in range(6)]
    changed = [" ".join(w if rng.random() > 0.04 else "new" for w in b.split(" ")) for b in base for _ in range(3)]
    odd = [None, "", " \n\t ", "one", "ONE", "two words", "é😀 ñ", "<|endoftext|>", "a  b \n c", words(rng, 6000), "z" * 3000]
    texts = [*base, *changed, *odd, base[0], base[0]]
    return texts, [*range(len(texts) - 2), 0, None]


def empty(spark):
    return spark.createDataFrame([], EXTRA)


def test_pieces_keep_pre_tokens():
    rng, pattern = random.Random(1), regex.compile(P.PATTERN)
    for _ in range(6000):
        text = "".join(rng.choice("abcdé1 2s..,,\n' _!\t") for _ in range(rng.randint(0, 14)))
        cut = pieces.pieces(text)
        assert "".join(cut) == text
        assert [m for x in cut for m in pattern.findall(x)] == pattern.findall(text)


def ranks():
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def test_bpe_equals_tiktoken(spark, messy):
    import tiktoken

    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks(), special_tokens={})
    texts, ids = messy
    found = encode_texts(frame(spark, texts, ids), P.path("byte_bpe_50k.tiktoken"), P.PATTERN, keep_ids=True).collect()
    want = []
    for i, t in zip(ids, texts, strict=True):
        tokens = own.encode_ordinary(t or "")
        want.append((i, len(tokens), hashlib.sha256(" ".join(map(str, tokens)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest(), tokens))
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, want))
    assert encode_texts(empty(spark), P.path("byte_bpe_50k.tiktoken"), P.PATTERN).count() == 0


def test_wavelet_answers():
    rng = np.random.default_rng(1)
    for n, top in ((0, 1), (1, 1), (700, 3), (5000, 50257), (3000, 70000)):
        ids = rng.integers(0, top, n)
        shard = wavelet.Shard(wavelet.build(ids, [None], [n]))
        assert (shard.decode() == ids).all()
        assert [shard.access(i) for i in range(0, n, 97)] == list(ids[::97])
        for token in {*map(int, ids[:5]), 80000}:
            assert list(shard.occurrences(token)) == list(np.flatnonzero(ids == token))
            assert shard.count(token, n // 3, n) == (ids[n // 3 :] == token).sum()


def test_wavelet_round_trip(spark, messy):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    texts, ids = messy
    found = wavelet.encode_round_trip(frame(spark, texts, ids), P.path("byte_bpe_50k.json"), 2).collect()
    order = sorted(zip(ids, texts, strict=True), key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or ""))
    at, want = 0, []
    for i, t in order:
        tokens = np.array([*model.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((i, at, len(tokens), zlib.crc32(tokens.tobytes())))
        at += len(tokens)
    assert sorted(map(tuple, found), key=lambda r: r[1]) == want
    assert wavelet.encode_round_trip(empty(spark), P.path("byte_bpe_50k.json"), 2).count() == 0


def shingles(text, width):
    w = regex.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def components_of(texts, ids, width, percent):
    sets = [shingles(t, width) for t in texts]
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    known = [k for k in range(len(ids)) if ids[k] is not None]
    for a in known:
        for b in known:
            both = len(sets[a] & sets[b])
            if a < b and sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both) or ids[a] == ids[b]:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    least = {find(k): min(ids[j] for j in known if find(j) == find(k)) for k in known}
    return [(ids[k], len(sets[k]), least[find(k)] if k in known else None) for k in range(len(ids))]


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates(spark, messy, width):
    texts, ids = messy
    found = near_duplicates(frame(spark, texts, ids), width, 80).collect()
    got = collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found)
    assert got == collections.Counter(components_of(texts, ids, width, 80))
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)
    assert near_duplicates(empty(spark), width, 80).count() == 0


def test_near_duplicates_of_a_large_group(spark, monkeypatch):
    """Hundreds of near copies around the threshold, so buckets stay mixed after the pivots and blocks decide."""
    monkeypatch.setattr(near_dup, "BLOCK", 16)
    rng = random.Random(2)
    base = words(rng, 80).split(" ")
    texts = [" ".join(w if rng.random() > rng.choice([0.02, 0.05, 0.08]) else words(rng, 1) for w in base) for _ in range(260)]
    found = near_duplicates(frame(spark, texts), 2, 80).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == sorted(components_of(texts, list(range(260)), 2, 80))


def test_fingerprints(spark, messy):
    texts, ids = messy
    found = fingerprints.compare_with_next(frame(spark, texts, ids)).collect()
    order = sorted(zip(ids, texts, strict=True), key=lambda x: (x[0] is None, -(x[0] or 0), x[1] or ""))
    order = [(i, t or "") for i, t in order]
    want = [(i, len(t), hashlib.sha256(fingerprints.edited(t, u).encode()).hexdigest()) for (i, t), (_, u) in zip(order, order[1:] + order[:1], strict=True)]
    assert sorted(map(repr, (tuple(r)[:3] for r in found))) == sorted(map(repr, want))
    by_text = {}
    for r in found:
        by_text.setdefault(dict(zip(ids, texts, strict=True)).get(r["doc_id"]) or "", set()).add(r["fingerprint"])
    assert all(len(v) == 1 for k, v in by_text.items() if k)
    grams = lambda t: {t[i : i + 8] for i in range(max(1, len(t) - 7))}
    long = [t for t in texts if t and len(t) > 200]
    prints = fingerprints.fingerprints(long)
    for x, y in zip(range(len(long)), range(1, len(long)), strict=False):
        true = len(grams(long[x]) & grams(long[y])) / len(grams(long[x]) | grams(long[y]))
        assert abs(fingerprints.likeness(prints[x : x + 1], prints[y : y + 1])[0] - true) < 0.17
    assert fingerprints.compare_with_next(empty(spark)).count() == 0


def brute_repeats(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        mark = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                mark[i : i + length] = b"\1" * length
        kept = bytes(x for x, m in zip(b, mark, strict=True) if not m)
        out.append((len(b), sum(mark), sum(1 for j, m in enumerate(mark) if m and not (j and mark[j - 1])), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize(("length", "alphabet"), [(1, "ab"), (20, "ab"), (64, "abcdé ")])
def test_repeats(spark, length, alphabet):
    rng = random.Random(length)
    some = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
    shared = [some(rng.randint(length, 3 * length)) for _ in range(5)]
    texts = [None, "", "z" * length, "y" * (3 * length)]
    texts += ["".join(rng.choice([some(rng.randint(0, 2 * length)), rng.choice(shared)]) for _ in range(rng.randint(1, 8))) for _ in range(40)]
    texts, ids = [*texts, texts[9], texts[9]], [*range(len(texts)), 9, None]
    found = repeats.remove_repeats(frame(spark, texts, ids), length, text_out=True).collect()
    want = [(i, *x) for i, x in zip(ids, brute_repeats(texts, length), strict=True)]
    assert sorted(map(repr, (tuple(r)[:5] for r in found))) == sorted(map(repr, want))
    assert all("�" not in r["kept_text"] for r in found)
    assert repeats.remove_repeats(empty(spark), length).count() == 0


def test_tiles_equal_plain_search():
    rng = np.random.default_rng(0)
    for _ in range(150):
        a, b = (rng.integers(0, 4, rng.integers(0, n)).astype(np.uint64) for n in (40, 60))
        free_a, free_b, want = [True] * len(a), [True] * len(b), []
        while True:
            best = (0, 0, 0)
            for i in range(len(a)):
                for d in range(len(b)):
                    n = 0
                    while i + n < len(a) and d + n < len(b) and a[i + n] == b[d + n] and free_a[i + n] and free_b[d + n]:
                        n += 1
                    best = (n, i, d) if n > best[0] else best
            n, i, d = best
            if n < decontaminate.MIN_MATCH:
                break
            want.append((i, d, n))
            for j in range(n):
                free_a[i + j] = free_b[d + j] = False
        assert decontaminate.tile(a, b) == want


def test_contaminated(spark):
    rng = random.Random(4)
    item = words(rng, 40).split(" ")
    moved = " ".join([*item[20:], "between", *item[:20]]).upper()
    texts = [" ".join(item), moved, words(rng, 10) + " " + " ".join(item[:30]), " ".join(item[:10]), words(rng, 50), None, "", "a b"]
    bench = spark.createDataFrame([(3, " ".join(item), "x"), (2, " ".join(item), "x"), (5, "a b", "x"), (6, None, "x"), (7, "", "x")], "item_id long, text string, doc_id string")
    found = {(r["doc_id"], r["item_id"]): (r["coverage"], r["n_tiles"]) for r in decontaminate.contaminated(frame(spark, texts), bench).collect()}
    assert found == {(0, 2): (1.0, 1), (1, 2): (1.0, 2), (2, 2): (0.75, 1)}
    assert decontaminate.contaminated(empty(spark), bench).count() == 0
    assert decontaminate.contaminated(frame(spark, texts), bench.limit(0)).count() == 0


def test_toxicity(spark):
    rng = random.Random(6)
    plain = [words(rng, rng.randint(20, 120)) for _ in range(300)]
    bad = [" ".join(x for w in words(rng, rng.randint(20, 120)).split(" ") for x in ([w, "nastyword"] if rng.random() < 0.1 else [w])) + " nastyword" for _ in range(120)]
    texts = [*plain, *bad, None, "", "   "]
    docs = frame(spark, texts)
    labels = spark.createDataFrame([(i, int(i >= 300)) for i in range(0, 420, 2)] + [(0, None), (None, 1), (0, 0)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    found = {r["doc_id"]: r for r in toxicity.scores(docs, model).collect()}
    held = [i for i in range(1, 420, 2)]
    assert np.mean([found[i]["predicted"] == (i >= 300) for i in held]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found.values())
    assert {found[i]["predicted"] for i in (420, 421, 422)} == {0}
    assert toxicity.passed(docs, model).columns == docs.columns
    assert toxicity.scores(empty(spark), model).count() == 0
    assert {r["score"] > 0.01 for r in toxicity.scores(docs, toxicity.fit(docs, labels.limit(0))).collect()} == {False}


def test_toxicity_dictionaries(spark):
    """Training keeps rare cells, works on any number of samples, and takes one row of a doc_id."""
    rng = random.Random(8)
    names = [bytes(rng.choices(b"abcdefghijklmnopqrstuvwxyz", k=8)) for _ in range(40)]
    cells = [x.ljust(toxicity.CELL, b"\xff") for x in names]
    samples = [b"".join(sorted({cells[min(int(rng.expovariate(0.2)), 39)] for _ in range(6)})) for _ in range(500)] + [cells[39]]
    held = toxicity.trained(samples, 2 * toxicity.CELL * 40, toxicity.CELL)
    used = {c[:8] for c in cells if any(c in x for x in samples)}
    assert len(used) > 25 and [x for x in used if x[:6] not in held and x[2:] not in held] == []
    assert names[0] in toxicity.trained(cells[:1], 512, toxicity.CELL)
    assert toxicity.trained([], 512, toxicity.CELL) == toxicity.trained([b"", b"short"], 512, toxicity.CELL) == b""
    # The tables before the content are gone, so nothing of a dictionary's head is matched.
    assert toxicity.OFFSETS not in held and not held.startswith(bytes.fromhex("37a430ec"))
    texts = [words(rng, 40) + (" awfulthing" * 3 if i % 2 else "") for i in range(80)]
    docs = frame(spark, texts)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    many = docs.unionByName(docs.where("doc_id = 1")).unionByName(docs.where("doc_id = 1")).withColumn("toxic", F.lit(7))
    one, more = toxicity.fit(docs, labels), toxicity.fit(many, labels)
    assert b"awful" in one.toxic and (one.toxic, one.ordinary) == (more.toxic, more.ordinary) and np.allclose(one.weights, more.weights)
    found = {r["doc_id"]: r["predicted"] for r in toxicity.scores(docs, one).collect()}
    assert [found[i] for i in range(60, 80)] == [i % 2 for i in range(60, 80)]
    # Labels of one kind only, and labels of no document.
    assert {r["predicted"] for r in toxicity.scores(docs, toxicity.fit(docs, labels.where("toxic = 0"))).collect()} == {0}
    assert toxicity.scores(docs, toxicity.fit(docs.limit(0), labels)).where("score IS NULL").count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href="/">Home</a></li></ul></nav>
<div class="ad">Buy this now, it is the best there is.</div><article><h1>Head &amp; more</h1><p>First <b>bold</b>
 line of the   article&nbsp;text.<p>Second line of it, &eacute;&#233; long enough to count.<script>var t="</p>";</script></p></article>
<section class="comments"><p>A reader says a lot of things here that are long.</p></section><form>Sign <input> up</form><footer>&copy; foot</footer></body></html>"""


def test_main_text(spark):
    want = "Head & more\nFirst bold line of the article text.\nSecond line of it, éé long enough to count."
    assert main_text.main_text(PAGE) == want
    assert main_text.main_text(PAGE.replace("article>", "div>")) == want
    pages = [(1, "u", PAGE, "x"), (1, None, PAGE, "x"), (None, "u", None, "x"), (2, "u", "", "x"), (3, "u", "only text", "x"), (4, "u", "<p>a<br>b</p><p></p>" + "<div>" * 300 + "deep", "x")]
    found = main_text.extract(spark.createDataFrame(pages, "page_id long, url string, html string, text string")).collect()
    assert sorted((str(r["page_id"]), r["text"], r["n_chars"]) for r in found) == sorted(
        [("1", want, len(want)), ("1", want, len(want)), ("None", "", 0), ("2", "", 0), ("3", "only text", 9), ("4", "a b\ndeep", 8)]
    )
    assert main_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_main_text_without_head_end():
    body = "<article><p>First line of the article.</p><p>Second line of the article.</p></article>"
    want = "First line of the article.\nSecond line of the article."
    heads = [
        "<head><title>x</title></head><body>", "<head><title>x</title><body>", "<head><title>x</title>", "<head><meta charset=a><noscript><link></noscript><body>",
        "<head><title>x</title><div></head><body>", "<head><div class=ad><span></head><body>", "<head><title>x<body>", "<head><noscript><p></head><body>", "<head><style>p{}</style><template><div></head>",
    ]
    for head in heads:
        assert main_text.main_text(f"<html>{head}{body}</body></html>") == want, head
    assert main_text.main_text("<head><title>x</title>Only text") == "Only text"
    assert main_text.main_text("<head><title>x</title><img src=a>Only text") == "Only text"


def test_main_text_keeps_all_clusters():
    rng = random.Random(3)
    long, short, lead, title = words(rng, 60), words(rng, 40), words(rng, 8), words(rng, 4)
    pages = [
        (f"<main><article><p>{long}</p></article><article><p>{short}</p></article></main>", [long, short]),
        (f"<main><h1>{title}</h1><p>{lead}</p><article><p>{long}</p><p>{short}</p></article></main>", [title, lead, long, short]),
        (f"<div><h1>{title}</h1><p>{lead}</p><div class=body><p>{long}</p><p>{long}</p><p>{short}</p></div></div>", [title, lead, long, long, short]),
        (f"<article><p>{long}</p></article><div><p>{short}</p></div>", [long, short]),
    ]
    for page, want in pages:
        assert main_text.main_text(f"<html><body><nav>Home</nav>{page}<footer>foot</footer></body></html>") == "\n".join(want), page


def test_main_text_names_in_content():
    rest = "<p>" + words(random.Random(2), 40) + "</p>"
    kept = [
        '<h2 id="related-work">Kept words</h2>', '<h2 id="search-algorithms">Kept words</h2>', '<h3 id="legal-status">Kept words</h3>', '<p id="comment-on-method">Kept words</p>',
        '<div class="side-by-side">Kept words</div>', '<header class="entry-header"><h1>Kept words</h1></header>', '<h2 class="header">Kept words</h2>',
        '<p class="notice">Kept words</p>', '<div class="alert">Kept words</div>', '<section id="login"><p>Kept words</p></section>', '<p>Kept <span class="comment">words</span></p>',
    ]
    for part in kept:
        for outer in ("article", "main"):
            found = main_text.main_text(f"<body><{outer}>{rest}{part}{rest}</{outer}></body>")
            assert found.split("\n")[1] == "Kept words", part
    for part in kept[:5]:
        assert "Kept words" in main_text.main_text(f"<body><div class='content no-sidebar'>{rest}{part}{rest}</div></body>"), part
    gone = ['<div class="ad">Gone</div>', '<section class="related">Gone</section>', '<div class="comments-area">Gone</div>', '<div id="comments">Gone</div>', '<ul class="x share">Gone</ul>', '<a class="ad">Gone</a>']
    for part in gone:
        assert "Gone" not in main_text.main_text(f"<body><article>{rest}{part}{rest}</article></body>"), part
    for part in [*gone, '<div class="cookie-banner">Gone</div>', '<div id="search">Gone</div>', '<div class="site-header">Gone</div>', '<td class="sidebar">Gone</td>']:
        assert "Gone" not in main_text.main_text(f"<body><div>{rest}{part}{rest}</div></body>"), part


def test_preferences(spark):
    rows = [
        (0, 0, "user", "hi"), (0, 1, "assistant", "yo"), (0, 2, "user", "q"), (0, 300, "assistant", "a"), (1, 0, "user", "hi"), (1, 1, "assistant", "yo"),
        (1, 2, "user", "q2"), (1, 3, "assistant", "b"), (2, 0, None, None), (2, 0, None, None), (None, 1, "user", "x"), (4, None, "user", "x"), (4, 1, "user", "same"), (5, 1, "user", "same"),
    ]
    turns = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, pair_id string")
    found = {(r["pair_id"], r["block"]): r for r in preferences.preference_pairs(turns, preferences.neighbouring_pairs(turns)).collect()}
    first = found[0, 0]
    assert first["prompt"] == "<|user|>\nhi\n<|end|>\n<|assistant|>\nyo\n<|end|>\n" and first["first_difference"] == 2
    start, size = map(int, first["rejected_spans"].split("+"))
    assert first["rejected"][start : start + size] == "b" and first["chosen_spans"] == ""
    assert found[0, 1]["chosen"] == "<|assistant|>\na\n<|end|>\n"
    assert found[2, 0]["first_difference"] is None and found[2, 0]["chosen"] == found[2, 0]["rejected"] == ""
    assert found[1, 0]["chosen"] == "<|unknown|>\n\n<|end|>\n"
    plan = preferences.preference_pairs(turns, preferences.neighbouring_pairs(turns))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
    none = turns.limit(0)
    assert preferences.preference_pairs(none, preferences.neighbouring_pairs(none)).count() == 0


def test_preferences_equal_sql(spark):
    from zonepulse.llm.queries import ORACLES

    assert compare(spark, connect(SF), SF, QUERIES["op5_preferences"], ORACLES["op5_preferences"])[0] is None


def test_warc(spark):
    pages = [(1, "http://a/\r\nX: y", PAGE, "x"), (None, None, None, "x"), (2, "u", "", "x"), (2, "u", "", "x")]
    source = warc.responses(spark.createDataFrame(pages, "page_id long, url string, html string, record string"), "2024-01-01T00:00:00Z")
    found = warc.derivatives(source).collect()
    assert len(found) == 8
    given = {r["record_id"]: r for r in source.collect()}
    for r in found:
        head, block = warc.parse(bytes(r["record"]))
        origin = given[head["WARC-Refers-To"]]
        assert head["WARC-Type"] == r["record_type"] and head["WARC-Block-Digest"] == warc.digest(block) and int(head["Content-Length"]) == len(block)
        assert r["source_digest"] == origin["payload_digest"] == warc.digest(bytes(origin["payload"]))
        if r["record_type"] == "conversion":
            assert block.decode() == warc.plain_text(bytes(origin["payload"]).decode())
        else:
            fields = dict(x.split(": ", 1) for x in block.decode().splitlines())
            assert fields["source-header-content-type"].startswith("text/html")
            assert fields["conversion-record-id"] in {x["record_id"] for x in found if x["record_type"] == "conversion"}
    assert warc.derivatives(source.limit(0)).count() == 0


def test_word_hashes_follow_the_pattern():
    space, fold = arrays.ascii_tables()
    import pyarrow as pa

    texts = ["", "A a b", None, " x\ty ", "ab", "c"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    hashed, rows = arrays.word_hashes(*arrays.utf8(batch, "text"), space, fold)
    assert list(rows) == [1, 1, 1, 3, 3, 4, 5] and hashed[0] == hashed[1] != hashed[2]


def thue_morse(n):
    """A word of n letters and its complement; a polynomial modulo 2**64 cannot tell the two apart from about 1,024 letters on."""
    s = "L"
    while len(s) < n:
        s += s.translate(str.maketrans("Lr", "rL"))
    return s[:n], s[:n].translate(str.maketrans("Lr", "rL"))


@pytest.mark.parametrize("n", [512, 1024, 2048])
def test_structured_texts_are_told_apart(spark, n):
    x, y = thue_morse(n)
    one, other = np.frombuffer((x + y).encode(), np.uint8), np.array([0, n])
    prints = arrays.PrimeRolling(one).of(other, other + n)
    assert prints[0] != prints[1]
    found = near_duplicates(frame(spark, [x, y, " ".join(x), " ".join(y), x]), 2, 80).collect()
    # Two letters make the same pairs of words, so the spaced texts are alike by definition.
    assert sorted((r["doc_id"], r["component_id"]) for r in found) == [(0, 0), (1, 1), (2, 2), (3, 2), (4, 0)]
    gone = repeats.remove_repeats(frame(spark, [x, y]), n).collect()
    assert [r["n_removed"] for r in gone] == [0, 0]
    assert sorted(r["n_removed"] for r in repeats.remove_repeats(frame(spark, [x, y, x]), n).collect()) == [0, n, n]


def test_tiles_of_structured_words():
    x, y = (np.array([ord(c) for c in s], np.uint64) for s in thue_morse(1024))
    tiles = decontaminate.tile(x, y)
    assert tiles and max(n for _, _, n in tiles) < 1024 and all((x[i : i + n] == y[d : d + n]).all() for i, d, n in tiles)
    assert decontaminate.tile(x, x)[0] == (0, 0, 1024)


def test_repeats_of_the_production_length(spark):
    """400 bytes: passages of 399 and 400 bytes, overlapping ones, runs of one letter, copies inside a document."""
    rng = random.Random(400)
    some = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    cut = lambda s, n: s.encode()[:n].decode("utf-8", "ignore")
    shared = [cut(some(900), n) for n in (399, 400, 401, 800)]
    texts = [some(rng.randint(0, 700)) + rng.choice(shared)[rng.randint(0, 3) :] + some(rng.randint(0, 500)) for _ in range(30)]
    texts += ["z" * 399, "z" * 400, "y" * 900, shared[3] * 3, "ab" * 450, "b" + "ab" * 300]
    found = repeats.remove_repeats(frame(spark, texts), 400).collect()
    assert sorted(tuple(r) for r in found) == [(i, *x) for i, x in enumerate(brute_repeats(texts, 400))]
    assert sum(r["n_removed"] for r in found) > 0


def test_broken_pages_take_linear_time(spark):
    """A megabyte of tags that nothing closes; the time bound leaves room for a busy machine."""
    import time

    assert main_text.main_text("<p>a</p><!-- c --><p>b</p><!-- open <p>d</p>") == "a\nb\nopen\nd"
    for piece in ("<!--", "<!-- x", "<div>x", "<p>x", "<a><div><b></a>", "<td>x", "</p>"):
        start = time.monotonic()
        main_text.main_text(piece * (1_000_000 // len(piece)))
        assert time.monotonic() - start < 15, piece
    for piece in ("<!--", "<!-- x", "<script>", "<head>x", "<div>x", "<"):
        start = time.monotonic()
        warc.plain_text(piece * (1_000_000 // len(piece)))
        assert time.monotonic() - start < 15, piece


def test_warc_text_of_written_pages():
    """Expected texts written out by hand."""
    cases = {
        "": "", "<p>a  b\n c</p><p>d &amp; e</p>": "a b c\nd & e", "x<!-- no -->y": "xy", "x<!-- y": "x<!-- y", "x<script>no</script >y<SCRIPT>no</SCRIPT>z": "x\ny\nz",
        "<head><title>t</title></head><body>b": "b", "<script>open <b>bold</b>": "open bold", "a<br>b<br/>c": "a\nb\nc", "<style>p{}</style><script><!-- x --></script>end": "end",
        "<b>in</b>line": "inline", "1 < 2 <i>ok</i>": "1 < 2 ok",
    }
    assert {k: warc.plain_text(k) for k in cases} == cases


def test_warc_records_carry_the_source(spark):
    source = warc.responses(spark.createDataFrame([(1, "u", PAGE), (2, None, None)], "page_id long, url string, html string"), "2024-01-01T00:00:00Z")
    origin = {r["record_id"]: r for r in source.collect()}
    for r in warc.derivatives(source).collect():
        head, _ = warc.parse(bytes(r["record"]))
        given = origin[head["WARC-Refers-To"]]
        assert head["Source-Payload-Digest"] == given["payload_digest"] and head["Source-Header-Content-Type"] == "text/html; charset=utf-8"
        assert head["Source-Header-Content-Length"] == str(len(given["payload"]))


def test_preferences_of_repeated_pairs(spark):
    turns = spark.createDataFrame(
        [(0, 0, "user", "hi"), (0, 1, "assistant", "a"), (1, 0, "user", "hi"), (1, 1, "assistant", "b"), (2, 0, "user", "hi"), (2, 1, "assistant", "c")],
        "conv_id long, turn long, role string, text string",
    )
    made = lambda rows: [tuple(r) for r in preferences.preference_pairs(turns, spark.createDataFrame(rows, "pair_id long, chosen_id long, rejected_id long")).collect()]
    once = made([(7, 0, 1)])
    assert len(once) == 1 and once[0][2] == 1 and once[0][3] == "<|user|>\nhi\n<|end|>\n" and once[0][4] == "<|assistant|>\na\n<|end|>\n"
    assert made([(7, 0, 1), (7, 0, 1), (7, 0, 1)]) == once
    both = made([(7, 0, 1), (7, 2, 1)])[0]
    assert both[3] == once[0][3] and both[4] == "<|assistant|>\na\n<|end|>\n<|assistant|>\nc\n<|end|>\n" and both[5] == once[0][5]
    same = made([(7, 0, 0)])[0]
    assert same[2] is None and same[4] == same[5] == ""


def test_near_duplicates_of_shared_ids(spark):
    """Different texts under one doc_id are one document, whatever the order of the rows."""
    rng = random.Random(11)
    a, b = words(rng, 60), words(rng, 60)
    rows = [(5, a), (5, b), (7, a + " x"), (8, b + " y"), (9, a), (10, b), (11, words(rng, 60)), (5, None), (12, b + " z w"), (None, a)]
    for _ in range(3):
        rng.shuffle(rows)
        found = near_duplicates(frame(spark, [t for _, t in rows], [i for i, _ in rows]), 2, 80).collect()
        got = collections.Counter((r["doc_id"], r["component_id"]) for r in found)
        assert got == collections.Counter([(5, 5)] * 3 + [(7, 5), (8, 5), (9, 5), (10, 5), (11, 11), (12, 5), (None, None)])


def test_wavelet_option_for_special_literals(spark):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    text = "a <|endoftext|> b<|endoftext|>\n<|endoftext|>.  <|endoftext|> c, <|endoftext|>"
    for plain in (False, True):
        model.encode_special_tokens = plain
        ids = np.array([*model.encode(text, add_special_tokens=False).ids, 2], "<u4")
        assert [tuple(r)[2:4] for r in wavelet.encode_round_trip(frame(spark, [text]), P.path("byte_bpe_50k.json"), 2, plain).collect()] == [(len(ids), zlib.crc32(ids.tobytes()))]
        assert plain != (50256 in ids)


def test_near_duplicates_filter_shuffles_no_text(spark):
    texts = spark.range(20_000).select(F.when(F.col("id") % 100 != 1, F.col("id")).alias("id"), F.col("id").cast("string").alias("text"))
    wanted = texts.where("id % 7 = 0").select("id")
    found = near_dup._maybe_in(texts, wanted)
    assert wanted.exceptAll(found.select("id")).isEmpty()
    assert wanted.count() <= found.count() <= wanted.count() + 20
    # Lines of the filter's own plan begin with a colon.
    plan = [x for x in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if not x.lstrip().startswith(":")]
    assert any("scalar-subquery" in x for x in plan) and not any("Join" in x for x in plan)
    assert near_dup._maybe_in(texts, wanted.where("id < 0")).isEmpty()


def test_piece_ids_equal_whole_texts_and_stay_bounded():
    from tokenizers import Tokenizer

    from zonepulse.llm.cuts import PieceIds

    model = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    rng = random.Random(5)
    marks = [" ", "  ", "\n", "\n\n", "\t", ".", ",", "..", "'s", "_", "\u00a0", "\u3000", "\u2003", "\x85", "\x00", "1", "23", "Wort", "é", "字", "<|endoftext|>", "<|", "|>", "a"]
    texts = ["".join(rng.choices(marks, k=rng.randrange(14))) for _ in range(4000)]
    asked = []
    cache = PieceIds(lambda x: asked.extend(x) or [e.ids for e in model.encode_batch_fast(x, add_special_tokens=False)], limit=500)
    for at in range(0, len(texts), 400):
        raw = [x.encode() for x in texts[at : at + 400]]
        ids, counts = cache(np.frombuffer(b"".join(raw), np.uint8), np.append(0, np.cumsum([len(x) for x in raw])))
        want = [e.ids for e in model.encode_batch_fast(texts[at : at + 400], add_special_tokens=False)]
        assert counts.tolist() == [len(x) for x in want]
        assert ids.tolist() == [i for x in want for i in x]
        assert len(cache.number) <= 500 + 400 * 14
    assert len(set(asked)) < len(asked)


def test_new_pieces_are_encoded_together():
    from tokenizers import Tokenizer

    from zonepulse.llm.cuts import TOGETHER, PieceIds

    model = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    sizes = wavelet.token_sizes(model)
    rng = random.Random(6)
    marks = [" ", " ", "  ", "\n", "\t", ".", ",", "'s", "\u00a0", "\u3000", "\x85", "\x00", "7", "Wort", " é", " 字", "é ", "<|endoftext|>", "<|", "a", " a", "😀"]
    odd = ["".join(rng.choices(marks, k=rng.randrange(14))) for _ in range(3000)]
    plain = [words(rng, 40) for _ in range(100)]

    def coded(texts, sizes):
        calls = []
        cache = PieceIds(lambda x: calls.append(len(x)) or [e.ids for e in model.encode_batch_fast(x, add_special_tokens=False)], sizes=sizes)
        raw = [x.encode() for x in texts]
        ids, counts = cache(np.frombuffer(b"".join(raw), np.uint8), np.append(0, np.cumsum([len(x) for x in raw])))
        want = [e.ids for e in model.encode_batch_fast(texts, add_special_tokens=False)]
        assert counts.tolist() == [len(x) for x in want]
        assert ids.tolist() == [i for x in want for i in x]
        return calls, len(cache.number)

    for special in (False, True):
        model.encode_special_tokens = special
        calls, _ = coded(odd, sizes)
        assert len(calls) == 1
    calls, distinct = coded(plain, sizes)
    assert len(calls) == 1 and calls[0] < distinct / TOGETHER + 2 * len(plain)
    # Sizes that do not add up are noticed, and every piece is encoded by itself.
    for wrong in (sizes + 1, sizes[::-1] + 1):
        assert coded(plain, wrong)[0] == [calls[0], distinct]
        coded(odd, wrong)
