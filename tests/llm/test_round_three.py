"""Pair bitmaps, licence notices and periodic runs against brute force, whole tables included, and on untidy rows."""

import collections
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import public_tokenizers as P

from zonepulse.llm import alignment, cuts, license_scan, runs
from zonepulse.llm.queries import QUERIES
from tests.llm.test_operators import empty, frame

SF = "/root/testdata/sf0.001"
ODD = [
    None, "", " ", "\n", "a ", " a", "  a  b \n\n c\n", "x<|endoftext|>y <s> </s> <0x41>", "▁a b", "汉字，没有空格。再来一句、好 的", "it's 'tis don't. 3.14 U.S.A. a,b",
    "x  y　 z w", "tab\tand\r\nnew", "a" * 3000, " " * 300, "😀😀 é ñ\x00 z", "…. ». ,, .. a.b,c", "x\x85 y\x1c z", "﻿ x", "one two " * 4000,
]


def table_texts():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


# --- pair bitmaps


def aligned(texts):
    """Rows of the contract, by plain loops over whole texts."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(x): x for x in shown}
    for x in range(256):
        if x not in shown:
            letters[chr(256 + len(letters) - len(shown))] = x
    rows, held = [], collections.Counter()
    for text in texts:
        rows.append(None)
        if not text:
            continue
        ia, ib = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        ba = [bytes(letters[c] for c in a.id_to_token(i)) for i in ia]
        bb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ib]
        if {b"".join(ba), b"".join(bb)} != {(" " + text).encode()}:
            continue
        ea, eb = np.cumsum([len(x) for x in ba]).tolist(), np.cumsum([len(x) for x in bb]).tolist()
        groups, i, j = [], 0, 0
        for e in sorted(set(ea) & set(eb)):
            x, y = ea.index(e, i) + 1, eb.index(e, j) + 1
            groups.append((ia[i:x], ib[j:y]))
            i, j = x, y
        links = collections.Counter((p, q) for x, y in groups for p in x for q in y)
        held.update(links.keys())
        spelt = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        rows[-1] = (len(ia), len(ib), len(groups), links, hashlib.sha256(spelt.encode()).hexdigest())
    top = collections.Counter()
    for (p, _), n in held.items():
        top[p] = max(top[p], n)
    out = []
    for row in rows:
        if row is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        na, nb, ng, links, digest = row
        out.append((na, nb, ng, sum(links.values()), sum(n for k, n in links.items() if held[k] == top[k[0]]), sum(n * held[k] for k, n in links.items()), digest))
    return out, held


def test_pair_bitmaps_equal_plain_loops(spark, monkeypatch):
    texts = [t for _, t in table_texts()] + ODD + ["the same text"] * 40
    want, held = aligned(texts)
    ids = [None if i == 3 else i // 2 if i < 20 else i for i in range(len(texts))]
    files = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
    docs = frame(spark, texts, ids)
    got = [tuple(r) for r in alignment.alignment_scores(docs, *files).collect()]
    assert collections.Counter(got) == collections.Counter((i, *w) for i, w in zip(ids, want, strict=True))
    index = alignment.pair_index(docs, *files)
    counts = alignment.pair_counts(index).collect()
    assert {(r["a"], r["b"]): r["count"] for r in counts} == dict(held)
    assert sum(r["n_pair_links"] for r in counts) == sum(w[3] for w in want)


def test_pair_bitmaps_of_the_table_and_of_none(spark):
    ids, texts = zip(*table_texts(), strict=True)
    want, _ = aligned(texts)
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op11_pair_bitmaps"](spark, SF).collect()}
    assert got == dict(zip(ids, want, strict=True))
    files = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
    assert alignment.alignment_scores(empty(spark), *files).count() == 0
    assert [tuple(r) for r in alignment.alignment_scores(frame(spark, [None, ""]), *files).collect()] == [(0, 0, 0, 0, 0, 0, 0, ""), (1, 0, 0, 0, 0, 0, 0, "")]


def test_chunks_do_not_change_scores(spark):
    """Links of many small chunks, and a memory of few pieces, give what one chunk gives."""
    with open(P.path("byte_bpe_50k.json"), encoding="utf-8") as f, open(P.path("piece_bpe_32k.model"), "rb") as g:
        known = alignment.Known(alignment.Tokenizers(f.read(), g.read()))
    assert known.t.cuttable
    texts = [t for _, t in table_texts()][:60] + ODD
    whole = alignment.Chunk()
    whole.add(known, pa.record_batch({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts)}))
    parts = collections.Counter()
    for i, text in enumerate(texts):
        known.clear()
        one = alignment.Chunk()
        one.add(known, pa.record_batch({"doc_id": pa.array([i], pa.int64()), "text": pa.array([text], pa.string())}))
        for p in one.postings():
            parts.update(dict(zip(p["pair"].to_pylist(), p["n_docs"].to_pylist(), strict=True)))
    both = {}
    for p in whole.postings():
        both.update(zip(p["pair"].to_pylist(), p["n_docs"].to_pylist(), strict=True))
    assert both == dict(parts)


def test_postings_round_trip():
    rng = random.Random(4)
    for n in (1, 7, 8, 9, 400):
        chunk = alignment.Chunk()
        links = {(rng.randrange(30), rng.randrange(n)): rng.choice([1, 1, 2, 3, 900]) for _ in range(n * 4)}
        chunk.n = n
        chunk.links = [(np.array([k[0] for k in links]), np.array([k[1] for k in links]), np.array(list(links.values())))]
        found = {}
        for p in chunk.postings():
            run, doc, times = alignment.unpack_postings(p["docs"], p["planes"], p["n_docs"].to_numpy())
            found.update({(int(x), int(d)): int(t) for x, d, t in zip(p["pair"].to_numpy()[run], doc, times, strict=True)})
        assert found == links


def test_cuts_stand_where_neither_tokenizer_goes_on():
    with open(P.path("byte_bpe_50k.json"), encoding="utf-8") as f, open(P.path("piece_bpe_32k.model"), "rb") as g:
        t = alignment.Tokenizers(f.read(), g.read())
    rng = random.Random(8)
    for _ in range(3000):
        text = " " + "".join(rng.choice(["a", "b", "é", " ", " ", "\n", ".", ",", "'", "s", "1", "。", " ", "　", "▁", "\t", "…"]) for _ in range(rng.randint(1, 16)))
        data = np.frombuffer(text.encode(), np.uint8)
        parts = [x.decode() for x in cuts.as_pieces(data, cuts.borders(data, np.array([0]), t.marks)).to_pylist()]
        assert "".join(parts) == text
        assert [i for x in t.encode_a(parts) for i in x] == t.encode_a([text])[0]
        assert [i for x in t.encode_b(parts) for i in x] == t.b.encode(text[1:])


# --- licence notices

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def plain_words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def base_row(text):
    found = plain_words(text)
    places = [(i, label) for phrase, label in BASE.items() for i in range(len(found)) if found[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return len(found), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def test_license_base_places_equal_a_word_scan(spark):
    rows = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.01/documents.parquet'").fetchall()
    got = {r["doc_id"]: r for r in QUERIES["op12_license_notices"](spark, "/root/testdata/sf0.01").collect()}
    assert len(got) == len(rows)
    for doc_id, text in rows:
        r = got[doc_id]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == base_row(text)
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
        assert (r["score"] > 0) == bool(r["labels"])


def distance(x, y):
    row = list(range(len(y) + 1))
    for i, c in enumerate(x, 1):
        row, old = [i], row
        for j, d in enumerate(y, 1):
            row.append(min(row[-1] + 1, old[j] + 1, old[j - 1] + (c != d)))
    return row[-1]


def test_license_errors_equal_edit_distance(spark):
    """Altered notices between other words: found exactly where some words lie within the bound, with the least edits."""
    rng = random.Random(3)
    texts = []
    for _ in range(150):
        notice = rng.choice(license_scan.NOTICES)
        letters = list(notice.loose)
        for _ in range(rng.randint(0, notice.errors + 1) if notice.loose else 0):
            at = rng.randrange(len(letters))
            letters[at : at + 1] = rng.choice([[], [letters[at], "q"], ["q"]])
        texts.append(rng.choice(["", "zulu zulu "]) + notice.fixed + "".join(letters) + rng.choice(["", " kilo kilo"]))
    texts += ["permit license", "it license", "cache license", "émit license", "mit license mit licence"]
    got = license_scan.license_spans(frame(spark, texts)).collect()
    for r in got:
        found = plain_words(texts[r["doc_id"]])
        for notice in license_scan.NOTICES:
            spans = [s for s in r["spans"] if s["phrase"] == notice.phrase]
            fits = {}
            for i in range(len(found)):
                for j in range(i + 1, len(found) + 1):
                    part = " ".join(found[i:j])
                    if part.startswith(notice.fixed) and abs(len(part) - len(notice.phrase)) <= notice.errors:
                        d = distance(part[len(notice.fixed) :], notice.loose)
                        if d <= notice.errors:
                            fits[i, j - i] = d
            assert bool(spans) == bool(fits), (texts[r["doc_id"]], notice)
            for s in spans:
                assert fits[s["first"], s["words"]] == s["edits"]
            if fits:
                assert min(s["edits"] for s in spans) == min(fits.values())


def test_license_untidy_rows(spark):
    texts = [*ODD, "MIT-License, CC BY!\ncc\x00by", "apach license", "x " * 50_000 + "Apache License", "mit license", "mit license"]
    ids = [*range(len(texts) - 1), None]
    got = {r["doc_id"]: r for r in license_scan.license_labels(frame(spark, texts, ids)).collect()}
    assert len(got) == len(texts)
    for doc_id, text in zip(ids, texts, strict=True):
        r = got[doc_id]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == base_row(text)
    # An error before the part that is found must not look into the row before.
    assert got[ids[-4]]["labels"] == "apache" and got[ids[-4]]["base_labels"] == ""
    assert license_scan.license_labels(empty(spark)).count() == 0


# --- periodic runs


def plain_runs(found, least=24):
    out = set()
    for q in range(1, len(found) // 3 + 1):
        i = 0
        while i + q < len(found):
            j = i
            while j + q < len(found) and found[j] == found[j + q]:
                j += 1
            n = j + q - i
            if j > i and n >= max(least, 3 * q) and not any(found[i : i + n - p] == found[i + p : i + n] for p in range(1, q)):
                out.add((i, n, q))
            i = j + 1
    return sorted(out, key=lambda x: (x[0], x[2]))


def run_row(doc_id, text):
    found = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(found)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        found = [w if i < a else found[a + (i - a) % p] for i, w in enumerate(found)]
    all_runs = plain_runs(found)
    dropped = {i for s, k, q in all_runs for i in range(s + q, s + k)}
    best = (None,) * 3
    for s, k, q in all_runs:
        if best[0] is None or k * best[2] > best[1] * q:
            best = s, k, q
    digest = hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in all_runs).encode()).hexdigest()
    rest = hashlib.sha256(" ".join(w for i, w in enumerate(found) if i not in dropped).encode()).hexdigest()
    return len(all_runs), *best, 1000 * best[1] // best[2] if all_runs else None, digest, rest


def test_runs_equal_plain_search():
    rng = random.Random(6)
    seen = 0
    for _ in range(300):
        rows = []
        for _ in range(rng.randint(0, 4)):
            k = rng.choice([1, 2, 3, 6])
            row = [rng.randrange(k) for _ in range(rng.randint(0, 50))]
            if row and rng.random() < 0.7:
                p = rng.randint(1, len(row))
                row += [row[i % p] for i in range(rng.randint(0, 100))] + [rng.randrange(k) for _ in range(rng.randint(0, 15))]
            rows.append(row)
        least = rng.choice([3, 6, 24])
        borders = np.cumsum([0, *map(len, rows)])
        found = runs.find_runs(np.array([x for r in rows for x in r], np.int64), borders, least)
        want = [(s + borders[i], n, q) for i, r in enumerate(rows) for s, n, q in plain_runs(r, least)]
        assert list(zip(*(x.tolist() for x in found), strict=True)) == want
        seen += len(want)
    assert seen > 500


def test_runs_of_the_table(spark):
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op13_periodic_runs"](spark, SF).collect()}
    rows = table_texts()
    assert len(got) == len(rows)
    checked = 0
    for doc_id, text in rows:
        if len(text or "") < 5000:
            assert got[doc_id] == run_row(doc_id, text)
            checked += got[doc_id][0] > 0
    assert checked > 5


def test_runs_untidy_rows(spark):
    fib = ["a", "ab"]
    while len(fib[-1]) < 600:
        fib.append(fib[-1] + fib[-2])
    texts = [*ODD[:-1], "x " * 23, "x " * 24, "x\t\n" * 25, "a b " * 12, "a b c d e f g h i " * 3, " ".join(fib[-1]), "é 😀 " * 30, "x " * 24, "x " * 24]
    ids = [*range(len(texts) - 2), 5, None]
    got = collections.Counter(tuple(r) for r in runs.periodic_runs(frame(spark, texts, ids), runs.planted).drop("n_words", "runs").collect())
    assert got == collections.Counter((i, *run_row(i, t)) for i, t in zip(ids, texts, strict=True))
    assert runs.periodic_runs(empty(spark)).count() == 0
    long = runs.periodic_runs(frame(spark, ["one two " * 40_000 + "end"]), keep_text=True).collect()[0]
    assert (long["n_runs"], long["start"], long["length"], long["period"], long["collapsed"]) == (1, 0, 80_000, 2, "one two end")
    assert long["exponent_milli"] == 40_000_000

