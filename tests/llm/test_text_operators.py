"""License scan, main text, token counts, media columns, byte-level BPE."""

import hashlib
import html
import random
import re
import struct
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken

from gridloom.llm import byte_bpe, token_counts
from gridloom.llm.html_main_text import extract_main_text, kept_blocks, text_of_blocks
from gridloom.llm.license_scan import SIGNATURES, Scanner, Taken, default_rules, license_digest, scan_licenses
from gridloom.llm.media_columns import describe, media_columns, media_digest, wrap_payloads, write_container
from gridloom.llm.token_counts import PieceTransducer, count_tokens, over_limit, prepared
from tests.llm.helpers import documents, empty, texts

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {("cc", "by"): "cc-by", ("general", "public", "license"): "gpl", ("all", "rights", "reserved"): "reserved"}


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def test_license_base_is_brute_force(spark):
    r = random.Random(5)
    parts = ["CC", "by", "cc-BY", "General", "public", "license.", "all", "Rights", "reserved", "©x", "cc,by", "word"]
    rows = [(k, " ".join(r.choice(parts) for _ in range(r.randint(0, 30)))) for k in range(200)] + [(900, None), (901, ""), (901, "")]
    got = license_digest(scan_licenses(documents(spark, rows))).collect()
    want = []
    for k, t in rows:
        w = WORD.findall(lower(t))
        hits = sorted((i, label) for p, label in PHRASES.items() for i in range(len(w)) if tuple(w[i : i + len(p)]) == p)
        want.append((k, len(w), len(hits), hits[0][0] if hits else None, hits[-1][0] if hits else None, ",".join(sorted({x[1] for x in hits}))))
    assert sorted(map(repr, want)) == sorted(repr(tuple(x)[:6]) for x in got)
    for x in got:
        assert set(filter(None, x["base_labels"].split(","))) <= set(x["labels"].split(",")) and 0 <= x["score"] <= 1


def test_license_rules_and_suppression():
    scan = Scanner(default_rules())
    assert len(default_rules()) > 200
    labels = lambda t: {d["label"] for d in scan.scan(t)[2]}
    assert labels("Licensed under the Apache License, Version 2.0.") == {"apache"}
    assert labels("Released under the MIT License.") == {"mit"}
    assert labels("SPDX-License-Identifier: BSD-3-Clause") == {"bsd"}
    assert labels("Licensed under CC BY-NC 4.0.") == {"cc-by", "cc-by-nc"}
    assert "gpl" in labels("This work is licensed under the GNU General Public License, version 3.")
    assert labels("nothing of the sort, a bit of common sense") == set()
    kept = scan.scan("licensed under the apache license version 2 0")[2]
    assert len(kept) == 1 and (kept[0]["first_word"], kept[0]["end_word"]) == (0, 8)


@pytest.mark.parametrize("text", ["cc by ", "all rights reserved ", "licensed under the ", "copyright 1999 ", "unauthorized use of this file "])
def test_license_scan_is_linear(text):
    scan = Scanner(default_rules())
    began = time.perf_counter()
    n, _, found = scan.scan(text * (1_000_000 // len(text)))
    assert n == len(text.split()) * (1_000_000 // len(text)) and time.perf_counter() - began < 20
    assert all(a["first_word"] <= b["first_word"] for a, b in zip(found, found[1:]))


def test_suppression_is_brute_force():
    r = random.Random(7)
    for _ in range(300):
        taken, kept = Taken(), []
        for _ in range(30):
            first = r.randrange(20)
            end = first + r.randint(1, 8)
            inside = any(a <= first and end <= b for a, b in kept)
            assert taken.add(first, end) == (not inside)
            kept.append((first, end))


def test_signatures_are_found():
    scan = Scanner(default_rules())
    for label, rows in SIGNATURES.items():
        for body, *_ in rows:
            plain = body if re.fullmatch(r"[a-z0-9 ]+", body) else None
            assert plain is None or label in {d["label"] for d in scan.scan(f"x {plain} y")[2]} or any(d["first_word"] <= 1 for d in scan.scan(f"x {plain} y")[2])


def test_license_edges(spark):
    assert scan_licenses(documents(spark)).count() == documents(spark).count()
    assert scan_licenses(empty(spark)).count() == 0


PAGE = """<html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body><header>Site</header>
<nav><ul><li><a href=/>Home</a></ul></nav><div class="cookie-notice">We use cookies</div><!-- <p>no</p> -->
%s<h1>A &amp; B</h1><p>First   &eacute;\n<b>bold<br>line<p>Short.</p><p>Third paragraph with a <a href=x>link</a> and some more words in it, so it is long.</p>%s
<aside>More</aside><section id="comments"><p>Great post, I have read it all twice and again!</p></section><form>Mail <input></form><footer>&copy; me</footer></body></html>"""
WANT = ["A & B", "First é bold line", "Short.", "Third paragraph with a link and some more words in it, so it is long."]


@pytest.mark.parametrize("tags", [("<article>", "</article>"), ("<main>", "</main>"), ('<div class="post-content">', "</div>"), ("", "")])
def test_main_text(tags):
    assert kept_blocks(PAGE % tags) == WANT


def test_main_text_edges(spark):
    assert kept_blocks(None) == kept_blocks("") == kept_blocks("<nav>x</nav>") == []
    assert kept_blocks("<article><p>cut off &lt;here") == ["cut off <here"]
    assert kept_blocks("<article>" + "<p>a" * 3000) == ["a"] * 3000
    assert kept_blocks("<article><p>a < b <!-- never closed") == ["a < b"]
    assert kept_blocks("<div class='ad'" + '"' * 999 + "<article><p>x</p></article>") is not None
    pages = spark.createDataFrame([(1, "u", "<article><p>é</p><p>b</p></article>", "c"), (2, None, None, "c")], "page_id long, url string, html string, blocks string")
    got = [tuple(r) for r in text_of_blocks(extract_main_text(pages, ["page_id", "url"]), ["page_id", "url"]).orderBy("page_id").collect()]
    assert got == [(1, "u", "é\n\nb", 4), (2, None, "", 0)]
    assert extract_main_text(pages.limit(0), ["page_id"]).count() == 0


def test_main_text_of_generated_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r in extract_main_text(pages.select("page_id", "html", "html"). toDF("page_id", "raw", "html"), ["page_id", "raw"]).collect():
        inside = r["raw"][r["raw"].index("<article>") + 9 : r["raw"].index("</article>")]
        parts = (" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inside.replace("<br>", " ")))
        assert r["blocks"] == [p for p in parts if p]


def test_windows_decide_without_marks(spark):
    """Without article elements, names and classes the lengths of lines find nearly the same text."""
    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect()]
    bare = [re.sub(r"<(/?)(?:article|main)\b[^>]*>", r"<\1div>", p) for p in pages]
    assert not any("<article" in p or "<main" in p for p in bare)
    same = sum(kept_blocks(a) == kept_blocks(b) for a, b in zip(pages, bare))
    assert same >= 0.98 * len(pages)
    short = "<div>" + "<p>one two</p>" * 2 + "<hr></div>"
    text = "<p>" + "a sentence of some length that goes on for a while, " * 4 + "</p>"
    found = kept_blocks(f"<body>{short}<nav>x</nav><div>{text * 3}</div><nav>x</nav>{short}</body>")
    assert len(found) == 3 and "one two" not in found


@pytest.mark.parametrize("page", [
    "<span>" * 60_000 + "</b>" * 60_000, "<a " * 300_000, "<p><td>" + "<span>" * 30_000 + "<hr>" * 30_000, "<ul><li>" + "<span>" * 30_000 + "<td>" * 30_000,
    "<article>&#" + "9" * 200_000 + ";", "<!-" * 300_000, '<a "' * 200_000 + ">", "<" * 900_000,
])
def test_main_text_is_linear(page):
    began = time.perf_counter()
    assert isinstance(kept_blocks(page), list) and time.perf_counter() - began < 15


def test_number_references():
    assert kept_blocks("<article><p>&#65;&#0000000000066;&#x43; &#99999999999999999999; &#" + "0" * 5000 + "68;") == ["ABC \ufffd D"]


@pytest.fixture(scope="module")
def pieces():
    path = public_tokenizers.path("piece_bpe_32k.model")
    return path, sentencepiece.SentencePieceProcessor(model_file=path)


def maps_of(machine, text, size):
    read = prepared(text) if text else ""
    return [machine.chunk_map(read[i : i + size]) for i in range(0, len(read), size)]


def test_counts_are_the_librarys(pieces):
    path, library = pieces
    machine, r = PieceTransducer.from_sentencepiece(path), random.Random(2)
    alphabet = [*" \n▁\x00\x1f　aabé中文字ab01😀", " the", "ing", " <s>", "</s>", "  ", "日本語"]
    for _ in range(3000):
        t = "".join(r.choice(alphabet) for _ in range(r.randint(0, 70)))
        want = len(library.encode(t))
        assert machine.count(t) == want, t
        for size in (1, 7, 23):  # many chunk maps
            assert machine.fold(maps_of(machine, t, size)) == (want if t else 0), (t, size)
    machine.STATES = 50  # starts anew again and again
    assert all(machine.count(t) == len(library.encode(t)) for t in texts() if t)


def test_chunk_maps_compose_in_any_order(pieces):
    machine = PieceTransducer.from_sentencepiece(pieces[0])
    text = " alpha beta\ngamma delta" * 5 + "x" * 50 + "unspacedwords" * 9
    maps = maps_of(machine, text, 7)
    left = right = None
    for m in maps:
        left = m if left is None else machine.compose(left, m)
    for m in reversed(maps):
        right = m if right is None else machine.compose(m, right)
    assert left == right


def test_chunk_maps_without_points(pieces):
    path, library = pieces
    machine, r = PieceTransducer.from_sentencepiece(path), random.Random(4)
    for letters in ("abcde", "the", "x", "日本語文字", "aé😀"):
        text = "".join(r.choice(letters) for _ in range(3000))
        for size in (1, 50, 1000):
            assert machine.fold(maps_of(machine, text, size)) == len(library.encode(text))
    machine.MET = 0  # no state on the way is known: every run goes to its end
    assert machine.fold(maps_of(machine, text, 100)) == len(library.encode(text))


def test_long_texts_are_cut(spark, pieces, monkeypatch):
    path, library = pieces
    monkeypatch.setattr(token_counts, "CHUNK", 50)
    monkeypatch.setattr(token_counts, "WHOLE", 100)
    rows = [(1, "a b " * 500), (2, "x" * 999), (2, "x" * 999), (None, "▁word\n  " * 60), (3, " " * 400), (4, "é😀" * 200), (5, "short"), (6, None)]
    got = sorted(map(repr, map(tuple, count_tokens(documents(spark, rows), path).collect())))
    assert got == sorted(repr((i, len((t or "").encode()), len(library.encode(t or "")))) for i, t in rows)


def test_token_counts_edges(spark, pieces):
    path, library = pieces
    got = over_limit(count_tokens(documents(spark), path), 4096).collect()
    want = [(r["doc_id"], len((r["text"] or "").encode()), len(library.encode(r["text"] or "")), len(library.encode(r["text"] or "")) > 4096) for r in documents(spark).collect()]
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got)
    assert count_tokens(empty(spark), path).count() == 0


def test_media_round_trip(spark):
    got = media_digest(media_columns(wrap_payloads(documents(spark)), ["doc_id", "n_bytes"])).collect()
    want = []
    for r in documents(spark).collect():
        b = (r["text"] or "").encode()
        p = b + bytes(-len(b) % 64 if b else 64)
        want.append((r["doc_id"], len(b), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:])))
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)[:5]) for r in got)
    assert media_columns(wrap_payloads(empty(spark)), ["doc_id"]).count() == 0


def test_media_walk():
    payload = random.Random(1).randbytes(64 * 600)
    media = write_container(payload)
    found = describe(media)
    assert found["n_samples"] == 600 and found["duration"] == 24 and found["codec"] == "raw "
    assert [k["sample"] for k in found["keyframes"]] == [0, 256, 512]
    assert all(media[k["offset"] : k["offset"] + k["size"]] == payload[64 * k["sample"] :][:64] for k in found["keyframes"])
    deep = b""
    for _ in range(5000):
        deep = struct.pack(">I4s", 8 + len(deep), b"moov") + deep
    many = media.replace(struct.pack(">II", 64, 600), struct.pack(">II", 64, 1 << 31))
    # A table of sizes that claims four thousand million samples and holds those of 600.
    claims = media.replace(b"stss", b"free").replace(struct.pack(">II", 64, 600), struct.pack(">II", 0, (1 << 32) - 1))
    assert claims != media.replace(b"stss", b"free")
    for broken in (claims, b"", b"abc", media[:100], b"\0" * 64, struct.pack(">I4s", 4, b"moov"), deep, many):
        assert describe(broken)["codec"] is None
    assert describe(None)["media_bytes"] is None


def test_bpe_is_the_librarys(spark, monkeypatch):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.ranks_of(path), special_tokens={})
    r = random.Random(3)
    bits = ["a", "B", "é", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "'s", "1", "²", ".", "!?", "中", "😀", "<|endoftext|>"]
    rows = [(k, "".join(r.choice(bits) for _ in range(r.randint(0, 40)))) for k in range(300)] + [(k + 500, t) for k, t in enumerate(texts())]
    got = byte_bpe.encoding_digest(byte_bpe.encode_documents(documents(spark, rows), path, public_tokenizers.PATTERN)).collect()
    want = []
    for k, t in rows:
        ids = library.encode_ordinary(t or "")
        want.append((k, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(repr, want)) == sorted(repr(tuple(x)) for x in got)
    assert byte_bpe.encode_documents(empty(spark), path, public_tokenizers.PATTERN).count() == 0
    assert byte_bpe.encode_documents(documents(spark), path, public_tokenizers.PATTERN).count() == documents(spark).count()


def test_pre_tokens_are_the_librarys_for_every_character():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.ranks_of(path), special_tokens={})
    encode = byte_bpe.word_encoder(path, public_tokenizers.PATTERN)
    every = [chr(c) for span in byte_bpe.CODE_POINTS for c in span]
    for k in range(0, len(every), 2048):
        words = byte_bpe.PreTokens(public_tokenizers.PATTERN)
        text = "".join(f"the{c}'s 1{c} {c}\n" for c in every[k : k + 2048])
        numbers, ids = words.of(text).tolist(), [encode(w.encode()) for w in words.numbers]
        assert b"".join(ids[n] for n in numbers) == np.array(library.encode_ordinary(text), "<u4").tobytes(), hex(ord(every[k]))


def test_bpe_forgets_and_goes_on(spark, monkeypatch):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    want = sorted(map(repr, map(tuple, byte_bpe.encode_documents(documents(spark), path, public_tokenizers.PATTERN).collect())))
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 2)
    monkeypatch.setattr(byte_bpe, "BLOCK", 50)
    monkeypatch.setattr(byte_bpe, "BUCKET", 1000)
    assert sorted(map(repr, map(tuple, byte_bpe.encode_documents(documents(spark), path, public_tokenizers.PATTERN).collect()))) == want


def test_bpe_blocks(monkeypatch):
    monkeypatch.setattr(byte_bpe, "BLOCK", 10)
    rows = dict(byte_bpe.block_rows(["a b a", "", "b"], public_tokenizers.PATTERN, 4))
    counts, flat = byte_bpe.unpack(rows[byte_bpe.DOCS])
    assert counts.tolist() == [3, 0, 1] and len(set(flat.tolist())) == 4


def test_pre_tokens_of_long_texts(monkeypatch):
    r = random.Random(4)
    bits = ["ab", "é", " ", " ", "  ", "\n", "\x85", "'s", "12", "!?", "中", "\U0001fae9"]
    for stretch in (1, 7):
        monkeypatch.setattr(byte_bpe, "STRETCH", stretch)
        words = byte_bpe.PreTokens(public_tokenizers.PATTERN)
        for _ in range(100):
            text = "".join(r.choice(bits) for _ in range(60))
            numbers = words.of(text).tolist()
            spelled = list(words.numbers)
            assert [spelled[n] for n in numbers] == words.exact(text)


def test_bpe_shuffles_each_word_once(spark):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = byte_bpe.encode_documents(documents(spark), path, public_tokenizers.PATTERN)
    assert len(encoded.collect()) == documents(spark).count()
    plan = encoded._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # Documents and words share one exchange, which is read twice; answers take the other. Words by block and again by bucket made three.
    assert len(set(re.findall(r"Exchange hashpartitioning.*?plan_id=(\d+)", plan))) == 2 and plan.count("ReusedExchange") == 1


BODY = ["A first paragraph that is long enough to stand for a whole article body here.", "Short.", "A second paragraph, and it is about as long as the first one of this body was."]
INNER = "".join(f"<p>{x}</p>" for x in BODY)


@pytest.mark.parametrize("page", [
    f"<div id='page' class='has-sidebar'><article>{INNER}</article></div>",
    f"<div class='layout-rail'><div class='search-results'><main>{INNER}</main></div><div class='sidebar'>More</div></div>",
    f"<div class='search-results'>{INNER}</div><div class='menu'>Home</div>",
    f"<div class='post has-comments'>{INNER}</div>",
    f"<div class='post-date'>1 May</div>{INNER}",
    f"<div class='post-lead'><p>{BODY[0]}</p></div>" + "".join(f"<p>{x}</p>" for x in BODY[1:]),
    f"<p>{BODY[0]}</p><div class='ad'>Buy</div><p>Short.</p><div class='ad'>Buy</div><p>{BODY[2]}</p>",
    f"<main>{INNER}</main><div id='comments'><article class='comment-body'>I have read this, and it is good.</article></div>",
    f"<div class='related'><article>Teaser</article></div>{INNER}",
])
def test_main_text_is_whole(page):
    assert [x for x in kept_blocks(f"<html><body>{page}</body></html>") if x not in ("Teaser", "1 May")] == BODY


def test_main_text_of_several_posts():
    assert kept_blocks(f"<div class='post has-comments'>{INNER}</div>" * 5) == BODY * 5


REMARKS = "".join(f"<p>Remark number {k}: I have read the whole of it and think that there is more to say here.</p>" for k in range(30))


@pytest.mark.parametrize("page", [
    f"<h1>Title</h1>{INNER}<div class='comments'>{REMARKS}</div>",
    f"<article>{INNER}</article><div class='comments'>{REMARKS.replace('<p>', '<article><p>').replace('</p>', '</p></article>')}</div>",
    f"<div class='post-content'>{INNER}</div><section id='respond' class='comment-content'>{REMARKS}</section>",
    f"<div class='comments-open post'><article>{INNER}</article><div class='commentlist comment-entry'>{REMARKS}</div></div>",
    f"<div id='disqus_thread'>{REMARKS}</div><div>{INNER}</div>",
])
def test_comments_go_however_long(page):
    assert [x for x in kept_blocks(f"<html><body>{page}</body></html>") if x != "Title"] == BODY


def test_a_page_of_comments_alone_keeps_them():
    assert len(kept_blocks(f"<p>Hi</p><div class='comments'>{REMARKS}</div>")) >= 30


def test_repeated_pages_are_rows(spark):
    pages = spark.createDataFrame([(1, "u", f"<article>{INNER}</article>")] * 3 + [(None, None, None)], "page_id long, url string, html string")
    got = [r["text"] for r in text_of_blocks(extract_main_text(pages, ["page_id", "url"]), ["page_id", "url"]).collect()]
    assert sorted(got) == sorted(["\n\n".join(BODY)] * 3 + [""])


def test_packed_numbers_lie_by_bytes():
    r = np.random.default_rng(2)
    ranks = np.minimum(r.zipf(1.2, 200_000), 60_000).astype("<u4")
    given = [np.zeros(0, int), np.array([0, 255]), ranks, np.array([1 << 31, 7]), b"some bytes", b""]
    back = byte_bpe.unpack(byte_bpe.pack(*given))
    assert all(a == b if isinstance(a, bytes) else a.tolist() == b.tolist() for a, b in zip(given, back)) and len(back) == len(given)
    assert len(byte_bpe.pack(ranks)) < 0.95 * len(zlib.compress(ranks.astype("<u2").tobytes(), 1))  # what it was before
