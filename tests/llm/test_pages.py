"""Extraction, archive and chat formatting."""

import base64
import hashlib
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from larder.llm import chat, extraction, warc
from larder.llm.labelled_pages import labelled_pages
from larder.llm.registry import CONTROL_TEXT, conversations
from larder.session import shared_folder

PAGES = "page_id long, url string, html string, address string, record_id string, payload long, text string, key int"


@pytest.fixture(scope="module")
def page_rows():
    page = '<html><head><title>T</title></head><body><nav><a href="/">Home</a></nav><article><h1>A &amp; B</h1><p><b>One <i>two</i>  three.<br><p>Four&nbsp;five</article><footer>&copy; x</footer>'
    rows = [(i, f"http://x/{i}", page.replace("Four", f"Four {i // 2}")) for i in range(10)]
    rows += [(20, None, page), (21, "http://y\r\n/", ""), (22, "u", None), (23, "u", "<p>" + "long text here. " * 20_000), (None, "u", page)]
    rows += [(24, "u", page), (24, "u", page), (25, "u", "no markup at all"), (26, "u", "<div"), (27, "u", "<script>if (a<b) {}</script><!-- x")]
    return rows


@pytest.fixture(scope="module")
def pages(spark, page_rows):
    return spark.createDataFrame([(*r, "a", "b", 1, "c", 2) for r in page_rows], PAGES).repartition(4)


@pytest.fixture(scope="module")
def no_pages(spark):
    return spark.createDataFrame([], PAGES)


def test_archive_round_trip(spark, pages, page_rows, no_pages):
    folder = f"{shared_folder(spark)}/test-warc-{uuid.uuid4().hex}"
    warc.write_archive(pages, folder)
    groups = {}
    for p, _, h in page_rows:
        groups.setdefault(h or "", []).append(p)
    expected = Counter()
    for p, _, h in page_rows:
        data = (h or "").encode()
        first = max((x for x in groups[h or ""] if x is not None), default=None)
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        own = p == first or first is None
        expected[p, len(data), digest, "response" if own else "revisit", None if own else first] += 1
    assert Counter(map(tuple, warc.parsed(warc.records(spark, folder)).collect())) == expected
    stored = [bytes(r.payload) for r in spark.read.parquet(f"{folder}/payloads").collect()]
    assert sorted(stored) == sorted(h.encode() for h in groups)
    whole = {r.record_id: bytes(r.record) for r in warc.records(spark, folder).collect()}
    body = next(h for p, _, h in page_rows if p == 3)
    assert whole[3].startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and whole[3].endswith(b"\r\n\r\n" + body.encode() + b"\r\n\r\n")
    payloads = {r.record_id: bytes(r.payload) for r in warc.records(spark, folder).collect()}
    assert payloads[2] == payloads[3] == body.encode()  # the revisit's through its response
    assert whole[2].endswith(b"Content-Length: 0\r\n\r\n\r\n\r\n") and b"WARC-Refers-To: <urn:page:3>" in whole[2]
    assert warc.records(spark, _empty(warc, no_pages, spark)).count() == 0


def _empty(module, frame, spark):
    folder = f"{shared_folder(spark)}/test-warc-{uuid.uuid4().hex}"
    module.write_archive(frame, folder)
    return folder


def test_small_payloads_are_all_responses(spark, pages):
    folder = f"{shared_folder(spark)}/test-warc-{uuid.uuid4().hex}"
    warc.write_archive(pages, folder, smallest=1 << 20)
    read = warc.parsed(warc.records(spark, folder))
    assert {r.record_type for r in read.collect()} == {"response"}
    payloads = spark.read.parquet(f"{folder}/payloads")
    assert payloads.count() == payloads.select("address").distinct().count()


def test_a_damaged_payload_is_noticed(spark, pages):
    folder = f"{shared_folder(spark)}/test-warc-{uuid.uuid4().hex}"
    warc.write_archive(pages, folder)
    bad = f"{folder}-bad"
    spark.read.parquet(f"{folder}/headers").write.parquet(f"{bad}/headers")
    spark.read.parquet(f"{folder}/payloads").selectExpr("address", "cast(concat(cast(payload AS string), 'x') AS binary) AS payload").write.parquet(f"{bad}/payloads")
    with pytest.raises(Exception, match="does not have the digest"):
        warc.records(spark, bad).collect()
    cut = warc.records(spark, folder).withColumn("record", F.expr("substring(record, 1, octet_length(record) - 5)"))
    with pytest.raises(Exception, match="header and payload differ"):
        warc.parsed(cut).collect()


def test_extraction(pages, page_rows, no_pages):
    got = Counter((r.page_id, r.text, r.n_chars) for r in extraction.extract(pages).collect())
    main = lambda i: f"A & B\nOne two three.\nFour{i} five"
    for p in range(10):
        text = main(f" {p // 2}")
        assert got[p, text, len(text)] == 1
    assert got[24, main(""), len(main(""))] == 2 and got[None, main(""), len(main(""))] == 1
    assert got[21, "", 0] == got[22, "", 0] == got[26, "", 0] == got[27, "", 0] == 1
    assert sum(got.values()) == len(page_rows)
    assert extraction.extract(no_pages).count() == 0


def test_held_out_accuracy():
    """Labels of blocks on pages the field was not fitted to."""
    field, right, total = extraction.trained_field(), 0, 0
    for html, labels in labelled_pages(200, seed=77):
        blocks = extraction.leaf_blocks(html)
        assert len(blocks) == len(labels)
        found = field.decode(extraction.block_places(blocks))
        right += sum(a == b for a, b in zip(found, labels))
        total += len(labels)
    assert right / total > 0.995


def test_whole_pages_table_gives_the_articles(spark, small_data):
    """On the given pages the main text is what the article element holds."""
    import html as entities
    import re

    rows = spark.read.parquet(f"{small_data}/pages.parquet").collect()
    found = {r.page_id: r.text for r in extraction.extract(spark.read.parquet(f"{small_data}/pages.parquet")).collect()}
    for row in rows:
        article = re.search(r"<article>(.*?)(</article>|\Z)", row.html, re.S)
        parts = re.split(r"</?(?:p|h1|br)>", article[1]) if article else []
        texts = [" ".join(entities.unescape(re.sub(r"<[^>]*(>|$)", "", p)).split()) for p in parts]
        assert found[row.page_id] == "\n".join(t for t in texts if t)


def test_viterbi_finds_the_best_labelling():
    import itertools

    import numpy as np

    rng = np.random.default_rng(5)
    for _ in range(50):
        field = extraction.Field(rng.normal(size=(extraction.PLACES, 2)), rng.normal(size=(2, 2)))
        places = [tuple(rng.integers(0, extraction.PLACES, 3).tolist()) for _ in range(6)]

        def value(labels):
            own = sum(field.margin[p] for label, chosen in zip(labels, places) for p in chosen if label)
            return own + sum(field.move[a, b] for a, b in zip(labels, labels[1:]))

        best = max(itertools.product((0, 1), repeat=6), key=value)
        assert abs(value(best) - value(field.decode(places))) < 1e-9
    assert extraction.trained_field().decode([]) == []


CHAT = "conv_id long, turn long, role string, text string, window int, place string, tokens string"


@pytest.fixture(scope="module")
def chats(spark):
    import random

    rng = random.Random(9)
    rows = []
    for c in range(12):
        if c % 2:
            rows.append((c, 0, "system", "Be <brief> & \"kind\"."))
        for t in range(1, 2 + 3 * c):
            rows.append((c, t, ("user", "assistant")[t % 2], "word " * rng.choice((0, 1, 5, 60, 300))))
    rows += [(50, 0, "user", None), (50, 1, "assistant", None), (51, 0, None, "x"), (51, None, "assistant", "&lt;</turn>\n")]
    rows += [(52, 0, "assistant", "tie"), (52, 0, "assistant", "tie"), (52, 0, "user", "tie"), (None, 0, "assistant", "no id")]
    rows += [(53, 0, "user", "q"), (53, 1, "assistant", "long " * 20_000), (53, 2, "user", "again"), (53, 3, "assistant", CONTROL_TEXT)]
    return rows


def test_chat_windows(spark, chats):
    frame = spark.createDataFrame([(*r, 1, "p", "t") for r in chats], CHAT).repartition(3)
    got = {r.conv_id: r for r in chat.digests(frame).collect()}
    windows = {}
    for r in chat.windows(frame).collect():
        windows.setdefault(r.conv_id, []).append(r)
    order = lambda v: (v is not None, v)
    for conv in {r[0] for r in chats}:
        turns = sorted((r[1:] for r in chats if r[0] == conv), key=lambda r: tuple(map(order, r)))
        said = "".join(f"{role or ''}\n{text or ''}\n" for _, role, text in turns)
        target = "".join(text or "" for _, role, text in turns if role == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(turns), hashlib.sha256(said.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(target), hashlib.sha256(target.encode()).hexdigest())
        assert r.formatted_chars == sum(len(w.formatted) for w in windows[conv])
        for w in windows[conv]:
            parts = w.formatted.split(chat.END)[:-1]
            tokens = sum(-(-len(p + chat.END) // chat.TOKEN_CHARS) for p in parts)
            assert tokens <= chat.BUDGET or len(parts) - w.n_context == 1
            if turns[0][1] == "system":
                assert parts[0].startswith('<turn role="system">')
            assert w.n_context <= chat.HISTORY_TURNS + 1
    assert len(windows[11]) > 1 and any(w.n_context > 1 for w in windows[11])
    assert chat.digests(frame.limit(0)).count() == 0


def test_control_conversation(spark, small_data):
    row = chat.digests(conversations(spark, small_data)).where("conv_id = -7").first()
    assert (row.n_turns, row.loss_chars) == (2, len(CONTROL_TEXT))
    assert row.loss_sha256 == hashlib.sha256(b"\\### Assistant: </turn> ok").hexdigest()


@pytest.mark.parametrize("start", ["<body>", "<body class=x>", "", "<p>", "<br>", "x "])
def test_head_without_end_tag_hides_nothing_of_the_body(start):
    """HTML allows </head> to be left out; only what can stand in a head belongs to it."""
    head = '<html><head><meta charset="utf-8"><title>T</title><style>p {}</style><template><div>no</div></template>\n'
    body = f"{start}<article><h1>A</h1><p>One two three.</p></article></body></html>"
    texts = [t for t, _, _ in extraction.leaf_blocks(head + body)]
    assert texts == [t for t, _, _ in extraction.leaf_blocks(head + "</head>" + body)]
    assert texts[-2:] == ["A", "One two three."]


def test_article_of_a_page_without_head_end_is_kept():
    field = extraction.trained_field()
    pages = [html for html, _ in labelled_pages(20, 77)]
    assert all("</head>" in html for html in pages)
    for html in pages:
        expected = extraction.main_text(html, field)
        assert expected and extraction.main_text(html.replace("</head>", ""), field) == expected


def test_deep_pages_take_linear_time():
    import time

    field = extraction.trained_field()
    start = time.perf_counter()
    deep = "<html><body><article>" + "".join(f"<div class='c{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}'>a b" for i in range(100_000)) + "</article></body></html>"
    assert len(extraction.leaf_blocks(deep)) == 100_000
    assert len(extraction.leaf_blocks("<div>" * 50_000 + "x" + "</b></i></nav>" * 50_000)) == 1
    extraction.main_text(deep, field)
    assert time.perf_counter() - start < 30


@pytest.mark.parametrize(
    "html, text",
    [
        ("<body><nav><a href=/>Home</a></nav><main><article><h1>On tides</h1><p>The sea rises twice a day, and falls again.</p>"
         "<p>Sailors have kept tables of it for centuries.</p></article></main><footer>Copyright us</footer>",
         "On tides\nThe sea rises twice a day, and falls again.\nSailors have kept tables of it for centuries."),
        ("<div class=header><a href=a>News</a><a href=b>Sport</a></div><div class='article content'><p>Rain is expected &amp; wind too.</p>"
         "<p>It will clear up<br>later this week.</p></div><div class='sidebar'><h3>Related</h3><ul><li><a href=c>More</a></li></ul></div>",
         "Rain is expected & wind too.\nIt will clear up later this week."),
    ],
)
def test_hand_written_pages(html, text):
    assert extraction.main_text(html, extraction.trained_field()) == text
