"""Cases that a review of the numbered operators found missing."""

import random
import time

import pyarrow as pa
from pyspark.sql import functions as F

from tests.llm import plain
from tokenloom.llm import html, lattice, licenses, minhash, repeats


def test_hot_minimizer_spreads(spark, make):
    """A short string in every document, each time between other words: its segments must not meet in one shard."""
    rng = random.Random(7)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    hot = " 0123456789 the string 0123456789 that all share "
    tails = [word(40) for _ in range(6)]
    rows = [(i, word(60) + hot + rng.choice(tails) + word(30)) for i in range(200)]
    frame = make(rows)
    texts = frame.select(F.col("doc_id").alias("id"), "text")
    packed = repeats.squeezed(texts)

    def load(most):
        got = repeats.dealt_segments(texts, packed, most=most).where("kind = 0").toPandas()
        sizes = [int(repeats.unpack(s).sum()) for s in got.sizes]
        return got.assign(bytes=sizes).groupby("part").bytes.sum()

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 32)  # 128 shards
    try:
        whole, split = load(10**9), load(20)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert 2 * split.max() < whole.max() and len(split) > 2 * len(whole)
    want = plain.without_repeats(rows)
    for most in (20, 10**9):
        got = {r[0]: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in repeats.remove_repeats(frame, most=most).collect()}
        assert got == want


def test_pages_of_several_parts():
    part = lambda word, n=5: "".join(f"<p>{word} {'words of this part go on ' * 8}{i}.</p>" for i in range(n))
    has = lambda page, *words: [w in html.main_text(page) for w in words]
    sections = "".join(f"<section><h2>Head{k}</h2><div>{part(f'body{k}')}</div></section>" for k in range(3))
    assert all(has(f"<body><nav><a href=1>Home</a></nav>{sections}<footer>f</footer></body>", *[f"{w}{k}" for w in ("Head", "body") for k in range(3)]))
    links = "<ul><li><a href=1>elsewhere</a></li><li><a href=2>elsewhere</a></li></ul>"
    main = f"<body><main><h1>Title</h1><article>{part('one')}</article><h2>Middle</h2><article>{part('two', 2)}</article></main>{links}</body>"
    assert has(main, "Title", "one", "Middle", "two", "elsewhere") == [True] * 4 + [False]
    bare = f"<body><article>{part('one')}</article><div><article>{part('two')}</article></div>{links}</body>"
    assert has(bare, "one", "two", "elsewhere") == [True, True, False]
    layout = f"<body><div class='layout sidebar'><div>{part('body')}</div><div class=sidebar><p>aside</p></div></div><div id=comments>{part('remark', 9)}</div></body>"
    assert has(layout, "body", "aside", "remark") == [True, False, False]
    assert has(f"<body><div class=ad>{'buy ' * 90}</div><article><p>short</p></article></body>", "buy", "short") == [False, True]


def test_wrapped_and_joint_notices(make):
    fill = " ".join(f"word{i}" for i in range(80))
    wrapped = "This work is licensed under a Creative Commons Attribution 4.0\nInternational License."
    rows = [
        (1, f"{fill}\n{wrapped}\n{fill}"), (2, wrapped.replace("\n", " ")), (3, "Licensed under CC BY 4.0. Licensed under CC BY-SA 4.0."),
        (4, "Licensed under CC BY-SA 4.0."), (5, f"{fill}\nLicensed under CC\nBY-SA 4.0.\n{fill}"), (6, f"This work is\n{fill}\nlicensed under a Creative Commons Attribution 4.0\nInternational License."),
        (7, f"Licensed {fill}\nunder {fill} CC {fill}\nBY 4 0"), (8, f"{fill}\nLicensed under CC BY 4.0.\n{fill}"),
    ]
    got = {r.doc_id: (r.labels, r.n_blocks) for r in licenses.scan(make(rows)).collect()}
    near = ("cc-by,cc-by-nc,cc-by-sa", 1)  # all but one word of the others, too
    assert got == {1: near, 2: near, 3: ("cc-by,cc-by-sa", 1), 4: ("cc-by-sa", 1), 5: ("cc-by-sa", 1), 6: ("", 0), 7: ("", 0), 8: ("cc-by", 1)}


def test_repeated_vectors(spark):
    base = [1.0, 2.0, -1.0, 0.5, 3.0, -2.0, 0.25, 1.5]
    rows = [(1, base), (1, base), (1, base), (2, [2 * x for x in base]), (3, [-x for x in base]), (3, None), (4, base), (4, [1.0] + [0.0] * 7), (None, base), (None, base)]
    for order in (rows, rows[::-1]):
        got = [(r.vec_id, r.n_links, r.component_id, r.kept) for r in lattice.near_duplicates(spark.createDataFrame(order, "vec_id long, embedding array<double>")).collect()]
        least = min((lattice._units(pa.array([v]))[0].tobytes(), v) for i, v in rows if i == 4)[1]
        four = (4, 2, 1, False) if least == base else (4, 0, 4, True)
        n = 2 if least == base else 1
        assert sorted(got, key=str) == sorted([(1, n, 1, True)] * 3 + [(2, n, 1, False)] + [(3, 0, 3, True)] * 2 + [four] * 2 + [(None, 0, None, False)] * 2, key=str)


def test_work_on_one_text_is_linear():
    """A megabyte of a repeated notice, and deep or unmatched tags."""
    index = licenses.TemplateIndex(licenses.template_sets(licenses.TEMPLATES), {}, licenses.THRESHOLD)
    own = licenses.words(b"This work is licensed under a Creative Commons Attribution 4.0 International License. " * 12_000)
    began = time.time()
    i = next(k for k, (_, t) in enumerate(index.templates) if t <= set(own) and b"work" in t)
    assert index.window(i, own) >= licenses.THRESHOLD
    part = licenses.words(b"Redistribution and use in source and binary forms, with or without modification, are permitted " * 10_000)
    assert all(index.window(k, part) < 1 for k, (_, t) in enumerate(index.templates) if not t <= set(part))
    pages = {"<b>x" * 25_000: "x" * 25_000, "<b>" * 50_000 + "</i>" * 50_000: "", "<div>x" * 25_000: "\n".join("x" * 25_000)}
    for page, want in pages.items():
        assert html.main_text(page) == want
    assert time.time() - began < 60


def test_repeated_near_copies_are_one_row_each(make):
    """Two near copies, each standing two hundred times under its id."""
    text = " ".join(f"word{i}" for i in range(200))
    rows = [(1, text), (2, text + " end")] * 200 + [(3, "something else altogether, with five words")]
    got = [(r["doc_id"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(make(rows)).collect()]
    assert len(got) == 401 and set(got) == {(1, 1, True), (2, 1, False), (3, 3, True)}
