"""Encoders, token files, page text and search against brute force and round trips."""

import html
import io
import math
import re
import tempfile
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer, normalizers

from ledgerfall.llm import html_text, pieces, search, token_files
from ledgerfall.llm.shared import table
from tests.llm.cases import awkward, documents, sentence

SF_DIR = "/root/testdata/sf0.01"
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def codec():
    with open(PIECES, "rb") as file:
        return pieces.Codec(file.read())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(), max_size=4))
def test_any_text_has_the_reference_ids_and_comes_back(codec, texts):
    texts = [text.encode("utf-8", "ignore").decode() for text in texts]
    ids, same = codec.encode(texts)
    assert all(same)
    assert codec.decode(ids) == [codec.normalized(text) for text in texts]
    assert [t[1:] if t[:1] == " " else t for t in codec.tokenizer.decode_batch(ids)] == codec.decode(ids)


def unigram_model() -> bytes:
    def number(value):
        out = b""
        while value > 127:
            out, value = out + bytes([value & 127 | 128]), value >> 7
        return out + bytes([value])

    def field(tag, data):
        return number(tag << 3 | 2) + number(len(data)) + data

    def piece(text, score, kind):
        return field(1, field(1, text.encode()) + number(2 << 3 | 5) + np.float32(score).tobytes() + number(3 << 3) + number(kind))

    vocabulary = [("<unk>", 0, 2), ("<s>", 0, 3), ("</s>", 0, 3)] + [(f"<0x{i:02X}>", 0, 6) for i in range(256)]
    vocabulary += [("▁", -3, 1), ("a", -2, 1), ("b", -2.5, 1), ("ab", -2.2, 1), ("▁ab", -2.4, 1), ("ba", -4, 1), ("▁a", -2.1, 1)]
    trainer = number(3 << 3) + number(1) + number(35 << 3) + number(1)
    rules = field(1, b"identity") + number(3 << 3) + number(1) + number(4 << 3) + number(1)
    return b"".join(piece(*p) for p in vocabulary) + field(2, trainer) + field(3, rules)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="ab ü", max_size=12))
def test_unigram_models_are_rebuilt_too(text):
    data = unigram_model()
    codec = pieces.Codec(data)
    assert codec.model.unigram and codec.model.byte_fallback and codec.model.remove_extra
    ids, _ = codec.encode([text])
    reference = sentencepiece.SentencePieceProcessor(model_proto=data)
    assert reference.decode(ids[0]) == reference.decode(reference.encode(text)) == codec.decode(ids)[0]
    score = lambda some: sum(codec.model.pieces[i][1] for i in some)
    assert score(ids[0]) == pytest.approx(score(reference.encode(text)))


def test_encoded_documents(spark):
    rows = awkward()
    got = pieces.encoded(documents(spark, *rows), PIECES, with_ids=True)
    reference = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    found = sorted(got.collect(), key=str)
    wanted = sorted((str(i), reference.encode(t or "")) for i, t, *_ in rows)
    assert sorted((str(r["doc_id"]), list(r["ids"])) for r in found) == wanted
    for r in found:
        assert r["parity"] and r["round_trip"] and r["n_pieces"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
    back = pieces.decoded(got, PIECES).collect()
    assert sorted((str(r[0]), r[1]) for r in back) == sorted((str(i), (t or "").replace("▁", " ")) for i, t, *_ in rows)
    assert pieces.encoded(documents(spark), PIECES).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=300))
def test_elias_fano(sizes):
    ends = np.cumsum(sizes, dtype=np.uint64)
    packed = token_files.EliasFano.of(ends)
    assert packed.ends().tolist() == ends.tolist()
    assert [packed.end(k) for k in range(len(ends))] == ends.tolist()
    if len(ends):
        bits = 8 * (len(packed.low) + 8 * len(packed.high))
        assert bits <= len(ends) * (3 + math.log2(max(1, int(ends[-1]) / len(ends)) + 1)) + 128


def test_documents_are_read_by_place():
    parts = [np.arange(n, dtype="<u4") * 7 for n in (3, 0, 1, 200, 5)]
    for top in (0, 70_000):
        some = [part + top for part in parts]
        file = token_files.TokenFile(token_files.to_bytes([5, None, 7, 8, 9], [p.tobytes() for p in some]))
        assert [file.document(k).tolist() for k in range(5)] == [p.tolist() for p in some]
        assert file.present.tolist() == [1, 0, 1, 1, 1]


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_words_give_the_ids_of_whole_texts(text):
    text = text.encode("utf-8", "ignore").decode() + " don't <|endoftext|> a<|startoftext|>b \x1c\x85 É é"
    tokenizer = Tokenizer.from_file(WORDS)
    with open(WORDS, encoding="utf-8") as file:
        encoder = token_files.WordEncoder(file.read())
    ids = np.frombuffer(encoder.encode([text])[0], "<u4").tolist()
    assert ids == tokenizer.encode(text, add_special_tokens=False).ids


def test_words_that_are_met_again_are_learnt_once(monkeypatch):
    monkeypatch.setattr(token_files, "MEMORY", 20)
    with open(WORDS, encoding="utf-8") as file:
        encoder = token_files.WordEncoder(file.read())
    learnt, learn = [], encoder.learn
    monkeypatch.setattr(encoder, "learn", lambda new: learnt.extend(new) or learn(new))
    texts = [f"often, größer {'x' * n} y{n} <|endoftext|>{n}" for n in range(1, 40)]
    tokenizer = Tokenizer.from_file(WORDS)
    for text in texts:
        ids = np.frombuffer(encoder.encode([text])[0], "<u4").tolist()
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids
        assert len(encoder.known) + len(encoder.before) <= 20
    assert len(learnt) == len({word for text in texts for word in text.split()})


def test_words_of_pieces_are_learnt_once(monkeypatch):
    monkeypatch.setattr(pieces, "MEMORY", 40)
    with open(PIECES, "rb") as file:
        codec = pieces.Codec(file.read())
    learnt, learn = [], codec.learn
    monkeypatch.setattr(codec, "learn", lambda new: learnt.extend(new) or learn(new))
    texts = [f"often  größer, {'x' * n}\n y{n} ▁▁ \x00é中文{n} 😀" for n in range(1, 40)] + ["", " ", "▁", "often"]
    for text in texts:
        ids, same = codec.encode([text])
        assert ids == [codec.tokenizer.encode(text, add_special_tokens=False).ids] and same == [True]
        assert len(codec.known) + len(codec.before) <= 40
    assert learnt.count("▁often") == 1 and len(learnt) == len(set(learnt))


def test_words_of_many_texts_are_looked_up_once(codec, spark, monkeypatch):
    class Counted(dict):
        asked = 0

        def __getitem__(self, word):
            self.asked += 1
            return super().__getitem__(word)

    texts = ["one two\nthree  one", "one  two", "", " ", "▁", "▁one▁▁", "one two one two " * 20, "\x00é 中文 😀one"] * 30
    monkeypatch.setattr(codec, "known", Counted(codec.known))
    ids, same = codec.encode(texts)
    assert ids == [codec.tokenizer.encode(text, add_special_tokens=False).ids for text in texts] and all(same)
    assert codec.known.asked < 30
    monkeypatch.setattr(pieces, "LOOKED_UP", 50)
    got = pieces.encoded(documents(spark, *((i, text or None) for i, text in enumerate(texts))), PIECES, with_ids=True)
    found = {r["doc_id"]: (list(r["ids"]), r["parity"], r["round_trip"]) for r in got.collect()}
    assert found == {i: (some, True, True) for i, some in enumerate(ids)}


def test_ascii_words_are_learnt_without_special_tokens():
    tokenizer, seen = Tokenizer.from_file(WORDS), []

    class Library:
        def encode_batch_fast(self, texts, add_special_tokens):
            seen.extend(texts)
            return tokenizer.encode_batch_fast(texts, add_special_tokens=add_special_tokens)

    encoder = token_files.WordEncoder(tokenizer.to_str())
    assert encoder.ascii_joined
    encoder.tokenizer = Library()
    text = " Don't, 'tis... (3.14) x_y a<b> \x1c\x7f  END.\n"
    assert np.frombuffer(encoder.encode([text, ""])[0], "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert not any(encoder.part in some for some in seen)


def test_words_that_a_normaliser_lengthens():
    tokenizer = Tokenizer.from_file(WORDS)
    tokenizer.normalizer = normalizers.Sequence([normalizers.Replace("q", "kw"), normalizers.Replace("sh", "s")])
    encoder = token_files.WordEncoder(tokenizer.to_str())
    assert not encoder.ascii_joined
    text = "q, shq a.shq qsh sh, q"
    assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("most", [1 << 21, 50])
def test_token_files(spark, monkeypatch, most):
    monkeypatch.setattr(token_files, "FILE_IDS", most)
    rows = [r for r in awkward() if r[0] != 9] + [(9, "two words")]
    got = token_files.written_and_read(documents(spark, *rows), WORDS).collect()
    tokenizer = Tokenizer.from_file(WORDS)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    ids = {(r[0], r[1]): [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 2] for r in rows}
    starts = np.cumsum([0, *(len(ids[r[0], r[1]]) for r in order)]).tolist()
    crc = lambda some: zlib.crc32(np.array(some, "<u4").tobytes())
    wanted = [(r[0], s, len(ids[r[0], r[1]]), crc(ids[r[0], r[1]])) for r, s in zip(order, starts) if r[0] is not None]
    assert sorted(tuple(r) for r in got if r[0] is not None) == sorted(wanted)
    assert sorted((r[2], r[3]) for r in got if r[0] is None) == sorted((len(ids[None, t]), crc(ids[None, t])) for i, t, *_ in rows if i is None)
    assert token_files.written_and_read(documents(spark), WORDS).collect() == []


PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body><!-- x --><header class=top>Site</header>
<nav><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></nav><aside>Side</aside><div class="cookie-notice">We use cookies</div>
<article><h1>Head &amp; more</h1><p>One <b>two</b>three<br>four&nbsp;five<p>Six
 <a href="x">seven</a> &#8364;<script>var a = "<p>no</p>";</script><div class="ad">Buy</div><form><input>Your name</form>
<ul><li>Item</ul></article><section id="comments"><p>Nice page, I read it all and agree with every word of it.</section>
<footer>&copy; x</footer></body></html>"""


@pytest.fixture(scope="module")
def model(spark):
    return html_text.train(table(spark, SF_DIR, "pages"))


def test_a_page_with_everything(model):
    assert html_text.main_text(PAGE, model) == "Head & more One twothree four five Six seven € Item"


def test_no_self_description(model):
    menu = "".join(f'<li><a href="/{i}">Entry {i}</a></li>' for i in range(8))
    story = "".join(f"<p>{sentence(i, 60)}.</p>" for i in range(5))
    page = f"<html><body><div><ul>{menu}</ul></div><div>{story}</div><div><a href='/x'>imprint</a></div></body></html>"
    text = html_text.main_text(page, model)
    assert text == " ".join(f"{sentence(i, 60)}." for i in range(5))


@pytest.mark.parametrize("around", ["div class='page has-sidebar'", "div id='two-column-side'", "form action=x", "div class=widget><div class=side"])
def test_names_around_the_content_do_not_lose_it(model, around):
    tags = [x.split()[0] for x in around.split("><")]
    close = "".join(f"</{tag}>" for tag in reversed(tags))
    story = " ".join(f"{sentence(i, 60)}." for i in range(4))
    paragraphs = "".join(f"<p>{sentence(i, 60)}.</p>" for i in range(4))
    other = f"<aside><article>{sentence(8, 9)}</article></aside><section id=comments><p>{sentence(9, 400)}</p></section>"
    menu = "".join(f"<li><a href=/{i}>Entry {i}</a></li>" for i in range(8))
    for inner in (f"<article>{paragraphs}</article>{other}", f"<div class=content>{paragraphs}</div>{other.replace('article', 'p')}"):
        assert html_text.main_text(f"<body><{around}>{inner}{close}", model) == story
        assert html_text.main_text(f"<body>{inner}<{around}>{sentence(9, 20)}{close}", model) == story
    assert html_text.main_text(f"<body><nav><ul>{menu}</ul></nav><{around}>{paragraphs}{close}", model) == story


@pytest.mark.parametrize("page", ["", "plain", "<", "<p", "</p></div>", "<script>x", "<!--", "<a<b>", "<p>&bogus;&#xZZ;", "<div>" * 3000, "<b>" * 3000 + "x", "<article>é😀"])
def test_broken_pages_do_not_fail(model, page):
    assert isinstance(html_text.main_text(page, model), str)


def test_messages_give_exact_marginals(model):
    """Against the sum over all labellings of small trees."""
    from itertools import product

    for page in ("<div><p>one</p><nav><a>x</a></nav></div>", PAGE[:420], "<article><p>a</p><div class=ad>b</div></article><p>c</p>"):
        nodes, _ = html_text.parse(page)
        nodes = nodes[:9]
        weigh, alone = html_text.potentials(nodes, model)
        chance = np.zeros((len(nodes), 3))
        for states in product(range(3), repeat=len(nodes)):
            power = sum(weigh[i, x] for i, x in enumerate(states))
            power += sum(html_text.EDGE[states[n.parent], x] for n, x, a in zip(nodes, states, alone) if not a)
            chance[range(len(nodes)), states] += math.exp(power)
        assert html_text.marginals(nodes, model) == pytest.approx(chance / chance.sum(1, keepdims=True), abs=1e-9)


def paragraphs(count, first=0):
    return [f"{sentence(first + i, 60)}." for i in range(count)]


@pytest.mark.parametrize("around", ["body", "article", "main", "div"])
@pytest.mark.parametrize("block", ['<div class="elementor-widget-container"><p>{}</p></div>', '<div class="elementor-widget-container">{}</div>', '<div class="side-by-side"><p>{}</p></div>'])
def test_a_name_that_most_of_the_page_bears_says_nothing(model, around, block):
    for count in (3, 12):
        page = f"<body><nav><a href=/>Home</a></nav><{around}>{''.join(block.format(x) for x in paragraphs(count))}</{around}></body>"
        assert html_text.main_text(page, model) == " ".join(paragraphs(count))


def test_headline_of_an_article(model):
    page = f"<body><header><h1>Site</h1></header><article><header><h1>Big title</h1></header><p>{sentence(1)}</p></article>"
    assert html_text.main_text(page, model) == f"Big title {sentence(1)}"


@pytest.mark.parametrize("comments", [5, 60])
@pytest.mark.parametrize("content", ["<article>{}</article>", "<div class=content>{}</div>", "<main><div>{}</div></main>"])
@pytest.mark.parametrize("around", ["<section id=comments>{}</section>", "<ol class='comment-list'>{}</ol>", "<div class='post-comments'>{}</div>", "<aside>{}</aside>"])
def test_prose_of_readers_is_not_content(model, comments, content, around):
    """However much of it there is, beside the content or within it."""
    story = "".join(f"<p>{x}</p>" for x in paragraphs(6))
    replies = around.format("".join(f"<div><p>{x}</p></div>" for x in paragraphs(comments, 100)))
    for page in (content.format(story) + replies, content.format(story + replies)):
        assert html_text.main_text(f"<body>{page}</body>", model) == " ".join(paragraphs(6))


def test_lists_and_short_lines_of_an_article(model):
    page = "<body><article><h1>Tt</h1><p>Short one.</p><ul><li>Item</li><li><a href=x>linked</a></li></ul><table><tr><td>a<td>b</table></article>"
    assert html_text.main_text(page, model) == "Tt Short one. Item linked a b"


def test_the_model_corrects_the_words():
    """What pages show of a name outweighs what was known of it, either way."""
    story = lambda i: "".join(f"<p>{x}</p>" for x in paragraphs(3, 3 * i))
    plain = html_text.count([f"<body><nav><a href=/>x y</a></nav><article>{story(i)}</article>" for i in range(60)])
    taught = html_text.count([
        f"<body><nav class=strip><a href=/>x y</a></nav><aside class=strip>{sentence(i, 50)}</aside><article><div class=rail>{story(i)}</div></article>"
        for i in range(60)
    ])
    other = f"<div><p>{sentence(500, 500)}</p></div>"
    rail, strip = f"<div class=rail>{sentence(9, 40)}</div>", f"<div class=strip><p>{sentence(9, 40)}</p></div>"
    has = lambda block, model: sentence(9, 40) in html_text.main_text(f"<body>{other}{block}</body>", model)
    assert (has(rail, plain), has(rail, taught)) == (False, True)
    assert (has(strip, plain), has(strip, taught)) == (True, False)


@pytest.mark.parametrize(
    "page",
    ["<a " * 350_000, "</x>" * 250_000, "<b>" * 350_000, "<b>" * 150_000 + "<p>" * 150_000, "<i><div>" + "<b>" * 150_000 + "</i>" * 150_000,
     "<div>" * 80_000 + "<td>" * 80_000, "<!--" * 250_000, '<a href="' * 120_000, "<![CDATA[" * 110_000, "<" * 1_000_000, "<li><div>" * 60_000,
     "<script>" * 130_000, "<p class='" * 100_000, "&amp" * 250_000, "<a b=c " * 150_000],
    ids=lambda page: page[:12],
)
def test_broken_pages_take_time_in_proportion(page, model):
    start = time.process_time()
    html_text.parse(page[: len(page) // 4])
    quarter = time.process_time() - start
    start = time.process_time()
    html_text.parse(page)
    assert time.process_time() - start < max(1.0, 10 * quarter)
    assert isinstance(html_text.main_text(page[:20_000], model), str)


def test_quotes_and_markup_in_attributes(model):
    text = lambda page: html_text.main_text(f"<article>{page}</article>", model)
    assert text("<p title='a > b' data-x=\"<p>\">one</p> two") == "one two"
    assert text('<p a"b>one</p>') == "one"
    assert text("<p title=it's>one</p> two 'three'") == "one two 'three'"
    assert text("a < b <3 c") == "a < b <3 c"
    assert text("<![CDATA[x <b> y]]> z") == "x <b> y z"
    assert text("one <p unclosed='two> three") == "one"


def test_pages_of_the_table(spark, model):
    rows = html_text.extracted(table(spark, SF_DIR, "pages"), model).join(table(spark, SF_DIR, "pages").select("page_id", "html"), "page_id").collect()
    assert len(rows) == table(spark, SF_DIR, "pages").count()
    for row in rows:
        article = re.search(r"<article>(.*)</article>", row["html"], re.S)[1]
        plain = re.sub(r"<[^>]*>", "", re.sub(r"<(?!/?b>)[^>]*>", " ", article))
        assert row["text"] == " ".join(html.unescape(plain).split()) and row["n_chars"] == len(row["text"])


def test_awkward_pages(spark, model):
    pages = spark.createDataFrame([(None, None, None, "t"), (1, "u", "", "t"), (2, "u", "<p>x", "t"), (2, "u", "<p>x", "t")], "page_id long, url string, html string, text string")
    got = html_text.extracted(pages, model)
    assert got.columns == ["page_id", "url", "text", "n_chars"] and got.count() == 4
    assert [r["n_chars"] for r in got.where("page_id IS NULL OR page_id = 1").collect()] == [0, 0]
    assert html_text.extracted(pages.limit(0), html_text.train(pages.limit(0))).collect() == []


def expected_search(docs, queries, k):
    words = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    known = [(i, words(t)) for i, t in docs if i is not None]
    mean = sum(len(w) for _, w in known) / max(1, len(known))
    having = Counter(w for _, some in known for w in set(some))
    out = []
    for q, text in queries:
        scored = []
        for i, some in known:
            counts, score = Counter(some), 0.0
            for w, n in Counter(words(text)).items():
                if counts[w]:
                    idf = math.log1p((len(known) - having[w] + 0.5) / (having[w] + 0.5))
                    score += n * idf * counts[w] * 2.2 / (counts[w] + 1.2 * (0.25 + 0.75 * len(some) / mean))
            if round(score, 6) > 0:
                scored.append((-round(score, 6), i))
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return out


@pytest.mark.parametrize("shard, run, k", [(8192, 64, 10), (7, 2, 5), (100, 1, 1)])
def test_search(spark, monkeypatch, shard, run, k):
    for name, value in (("SHARD_DOCS", shard), ("RUN", run), ("BLOCK_DOCS", 4), ("QUERY_BLOCK", 3), ("TOGETHER", 2), ("FIRST_BLOCKS", 2)):
        monkeypatch.setattr(search, name, value)
    docs = [(i, t) for i, t, *_ in awkward() if i not in (6, 7)] + [(100 + i, sentence(i % 25, 30 + i)) for i in range(60)]
    queries = [(i, t) for i, t in docs if i is not None and i % 20 == 0] + [(1, None), (2, ""), (3, "zzz never seen"), (4, "one ONE Two")]
    frame = documents(spark, *docs)
    asked = spark.createDataFrame(queries, "query_id long, text string")
    got = sorted((tuple(r) for r in search.top_k(frame, asked, k).collect()))
    wanted = sorted(expected_search(docs, queries, k))
    assert [g[:2] for g in got] == [w[:2] for w in wanted]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in wanted], abs=2e-6)


def test_blocks_of_queries_share_shards(spark, monkeypatch, tmp_path):
    loads, real = str(tmp_path), search.Shard

    def counted(*args):
        with tempfile.NamedTemporaryFile(dir=loads, delete=False):
            return real(*args)

    cores = spark.sparkContext.defaultParallelism
    for name, value in (("Shard", counted), ("SHARD_DOCS", 10), ("QUERY_BLOCK", 1)):
        monkeypatch.setattr(search, name, value)
    docs = documents(spark, *((i, sentence(i, 12)) for i in range(30))).coalesce(1)
    asked = spark.createDataFrame([(i, sentence(i % 30, 12)) for i in range(6 * cores)], "query_id long, text string")
    got = {r["query_id"]: r["doc_id"] for r in search.top_k(docs, asked.coalesce(1), 1).collect()}
    assert got == {i: i % 30 for i in range(6 * cores)}
    assert len(list(tmp_path.iterdir())) <= 3 * 6 * cores // 2


def test_documents_are_taken_apart_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    docs = documents(spark, *((i, sentence(i, 12)) for i in range(30))).select("doc_id", "text")
    asked = spark.createDataFrame([(1, sentence(3, 12))], "query_id long, text string")
    assert search.top_k(docs.mapInPandas(counted, docs.schema), asked, 1).first()["doc_id"] == 3
    assert read.value == 30


@pytest.mark.parametrize("few", [0, 512])
def test_copies_and_close_scores(spark, monkeypatch, few):
    for name, value in (("FEW", few), ("BLOCK_DOCS", 4), ("FIRST_BLOCKS", 1)):
        monkeypatch.setattr(search, name, value)
    docs = [(i, "one two three " * (1 + i % 2)) for i in range(90)]
    # Lengths of some thousand words: scores that single precision does not tell apart.
    docs += [(100 + i, "one four " * 3 + "many " * (4000 + i)) for i in range(40)] + [(200, "three")]
    queries = [(1, "one two"), (2, "one four"), (3, "four " * 50), (4, "many")]
    asked = spark.createDataFrame(queries, "query_id long, text string")
    got = sorted(tuple(r) for r in search.top_k(documents(spark, *docs), asked, 5).collect())
    wanted = sorted(expected_search(docs, queries, 5))
    assert [g[:3] for g in got] == [w[:3] for w in wanted]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in wanted], abs=2e-6)


def test_alike_documents_share_a_matrix(spark, monkeypatch):
    for name, value in (("BLOCK_DOCS", 4), ("TILE_BLOCKS", 4), ("GROUPS", 64)):
        monkeypatch.setattr(search, name, value)
    # 16 languages of 20 words, each word in less than one document in 32: frequent among its own, rare in all.
    text = lambda i: " ".join(f"w{i % 16}x{(i // 16 * 7 + j * j) % 20}" for j in range(10)) + " any" * (i % 37 == 0)
    docs = [(i, text(i)) for i in range(640)]
    words = pyarrow.chunked_array([pyarrow.array([t.split() for _, t in docs])])
    index = search.build_index(np.arange(len(docs)), words)
    all_pairs = sum(len(set(t.split())) for _, t in docs)
    assert index["having"].sum() == all_pairs == np.count_nonzero(index["matrix"]) + len(index["row_docs"]) + len(index["left_docs"])
    assert len(index["row_docs"]) + len(index["left_docs"]) < all_pairs / 4
    shard = search.Shard(index, sum(len(t.split()) for _, t in docs) / len(docs))
    assert sum(tile.dense.size for tile in shard.tiles) < 640 * len(index["names"]) / 4
    queries = [(i, t) for i, t in docs if i % 20 == 0] + [(1, "any"), (2, "any w3x4 w5x6 w5x6")]
    asked = spark.createDataFrame(queries, "query_id long, text string")
    got = sorted(tuple(r) for r in search.top_k(documents(spark, *docs).coalesce(1), asked, 4).collect())
    wanted = sorted(expected_search(docs, queries, 4))
    assert [g[:3] for g in got] == [w[:3] for w in wanted]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in wanted], abs=2e-6)


def test_empty_search(spark):
    asked = spark.createDataFrame([(1, "x")], "query_id long, text string")
    assert search.top_k(documents(spark), asked).collect() == []
    assert search.top_k(documents(spark, (1, "x")), asked.limit(0)).collect() == []
