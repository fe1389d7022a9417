from pelagos.llm import op3_extraction as op

NAV = "<nav><ul><li><a href='/a'>Menu</a></li><li><a href='/b'>More</a></li></ul></nav>"


def page(article, head="Title", tail=""):
    return f"<!DOCTYPE html><html><head><title>{head}</title><style>p{{x:1}}</style><script>var t='</p>';</script></head><body>{NAV}<!-- ad --><div class=\"ad\">Buy now</div>{article}<footer>&copy; us</footer></body></html>{tail}"


def run(spark, rows):
    return {r.page_id: r.text for r in op.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_known_articles(spark):
    rows = [(i, f"http://h{i % 2}.example.com/{i}", page(f"<article><h1>Head {i} &amp; tail</h1><p><b>One\n {i}<br><p>Two&nbsp;&lt;x&gt;</p>{'<p>extra</p>' * (i % 3)}</article>")) for i in range(9)]
    got = run(spark, rows)
    for i in range(9):
        assert got[i] == "\n\n".join([f"Head {i} & tail", f"One {i}", "Two <x>"] + ["extra"] * (i % 3))


def test_furniture_goes(spark):
    body = "<main><p>Keep me</p><form><p>Your name</p><input></form><aside>Side</aside><div class='cookie-notice'>Cookies</div><section id='comments'><article class='comment'><p>First!</p></article></section><ul><li>item <i>one</i></li><li>two</li></ul></main>"
    assert run(spark, [(1, "http://a/1", page(body))])[1] == "Keep me\n\nitem one\n\ntwo"


def test_template_without_article(spark):
    rows = [(i, "http://b.example/", f"<html><body><h2>Welcome to our site</h2><div><p>Story {i} is long</p><p>It ends {i}</p></div></body></html>") for i in range(5)]
    assert run(spark, rows)[3] == "Story 3 is long\n\nIt ends 3"


def test_template_inside_an_article(spark):
    extra = ["", "", "<blockquote>Only here</blockquote>", ""]
    rows = [(i, "http://d.example/", page(f"<article><h1>Head {i}</h1><div>Read our magazine</div><p>Story {i}</p><p>Goes on</p>{extra[i]}</article>")) for i in range(4)]
    got = run(spark, rows)
    for i in range(4):
        assert got[i] == "\n\n".join([f"Head {i}", f"Story {i}", "Goes on"] + ["Only here"] * (i == 2))


def test_wrapper_of_all_different_pages(spark):
    body = "<html><body><h2>Welcome to our site</h2><div><p>Story {0} is long</p><p>It ends {0}</p></div></body></html>"
    some = [body.format(i) for i in range(6)]
    for copied in some:  # whichever has the lowest hash
        rows = [(i, "http://e.example/", p) for i, p in enumerate(some + [copied] * 9)]
        assert run(spark, rows)[3] == "Story 3 is long\n\nIt ends 3"
    odd = [(i, "http://f.example/", body.format(i).replace("Welcome to our site", "News" if i < 12 else f"News of {i}")) for i in range(40)]
    got = run(spark, odd)  # shared by some pages only
    assert all(got[i].startswith("News") for i in range(40))


def test_edge_cases(spark):
    rows = [(1, None, None), (2, "x", ""), (2, "x", ""), (3, "http://c/", "plain & text"), (4, "http://c/", "<p>cut <b>off"), (5, "http://c/", page("<article>" + "<p>w </p>" * 3000)), (6, "http://c/", "<script>never closed <p>x")]
    got = run(spark, rows)
    assert got[1] == got[2] == got[6] == "" and got[3] == "plain & text" and got[4] == "cut off" and got[5] == "\n\n".join(["w"] * 3000)
    assert run(spark, rows[:0]) == {}


def test_wrapper_is_a_union_free_expression():
    a, b = (op.expression(page(f"<article><h1>{t}</h1>{'<p>x</p>' * n}</article>")) for t, n in (("A", 1), ("B", 4)))
    text = op.show(op.align(a, b))
    assert "<h1>#text</>" in text and "(<p>'x'</>)+" in text and "(<li>" in text


def test_repeated_groups_and_optional_items():
    e = op.fold(op.expression("<dl><dt>a</dt><dd>b</dd><dt>c</dt><dd>d</dd></dl>"))
    assert op.show(e) == "<dl>((<dt>#text</> <dd>#text</>))+</>"
    both = op.align(op.expression("<p>a</p><hr>"), op.expression("<p>a</p>"))
    assert op.show(both) == "<p>'a'</> (<hr></>)?"


def test_pages_of_the_tables(spark, sf):
    rows = op.query(spark, sf).collect()
    assert rows and all(r.n_chars == len(r.text) and "track(" not in r.text and "©" not in r.text for r in rows)


def known_pages():
    """(host, html, article) of 64 pages of four hosts, built around known articles."""
    import random
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(2, 9)))
    say = lambda n: " ".join(word() for _ in range(n))
    out = []
    for i in range(64):
        blocks = [say(5)] + [say(rng.randint(8, 30)) for _ in range(rng.randint(1, 5))]
        body = f"<h1>{blocks[0]}</h1>" + "".join(f"<p>{b}</p>" for b in blocks[1:])
        menu = "".join(f"<li><a href='/{w}'>{w}</a></li>" for w in ("news", "about", "shop", "team"))
        more = "".join(f"<li><a href='/x'>{say(4)}</a></li>" for _ in range(3))
        kind = i % 4
        if kind == 0:  # a fixed text inside the article
            html = f"<body><nav>{menu}</nav><article>{body}<div>Support our paper</div></article><footer>(c)</footer></body>"
        elif kind == 1:  # no article, no telling label
            html = f"<body><div id='top'><ul>{menu}</ul></div><div id='mid'>{body}</div><div id='rest'><b>More stories</b><ul>{more}</ul></div><div id='end'><p>All rights with us</p></div></body>"
        elif kind == 2:  # hints that mislead, and hints that don't
            blocks.append(say(25))
            html = f"<body><article>{body}<section class='related-work'><p>{blocks[-1]}</p></section><div class='related'><ul>{more}</ul></div></article></body>"
        else:  # comments vary as articles do
            html = f"<body><main>{body}<form><p>Write to us</p></form><section class='comments'><p>{say(12)}</p></section></main></body>"
        out.append((f"h{kind}.example.com", f"<html><head><title>t</title></head>{html}</html>", "\n\n".join(blocks)))
    return out


def test_known_pages_need_the_wrapper(spark):
    pages = known_pages()
    got = run(spark, [(i, f"http://{h}/{i}", p) for i, (h, p, _) in enumerate(pages)])
    assert [i for i, (_, _, text) in enumerate(pages) if got[i] != text] == []
    alone = [op.extract(p, {}) == text for _, p, text in pages]
    assert not any(alone[0::4]) and not any(alone[1::4]) and not any(alone[2::4])


def test_deep_and_wide_pages(spark):
    deep = "<div>" * 10_000 + "core" + "</div>" * 10_000
    wide = "".join(f"<p class='k{'abcdefghij'[i % 10]}{'xyzuvw'[i % 6]}'>t{i}</p>" for i in range(4000))
    rows = [(1, "http://deep/1", deep), (2, "http://deep/2", deep.replace("core", "heart")), (3, "http://wide/1", wide), (4, "http://wide/2", wide.replace("t1", "s1")), (5, "http://b/", "<b>" * 3000 + "bold")]
    got = run(spark, rows)
    assert got[1] == "core" and got[2] == "heart" and got[3] == "\n\n".join(f"t{i}" for i in range(4000)) and got[5] == "bold"


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "http://h/", "<p>text</p>", "a", "b", 3)], "page_id long, url string, html string, host string, wrapper string, n_chars int")
    assert op.extracted(df).collect() == [(1, "http://h/", "text", 4)]
