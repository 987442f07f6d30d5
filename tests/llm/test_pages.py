"""Main text and WARC archives."""

import hashlib
import random
import re

import brute
import numpy as np
import pytest
from brute import SF_SMALL, frame  # noqa: F401 (a fixture)
from pyspark.sql import functions as F

from adlift.llm import html_suffix, queries, warc_index
from adlift.llm.common import shared_path

MENU = "Home Products Prices About us Contact Help Blog Jobs Press"
NOTICE = "We use small files on your device to make this site work better for you"


def full_page(title, body):
    return f"""<!doctype html><html><head><title>{title}</title><style>p{{}}</style><script>x="<p>no</p>"</script></head><body>
<header class="site-header"><a href="/">Logo</a></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
<div class="cookie-notice">Accept cookies?</div><aside>Side</aside><div id="sidebar-left">Side too</div>
<article class="post"><header><h1>{title}</h1><p>By A. Writer</p></header>{body}<form><input><button>Go</button></form>
<div class="ad-box">Buy</div><!-- <p>hidden</p> --></article>
<section id="comments"><article class="comment"><p>First!</p></article></section>
<footer>&copy; me</footer></body></html>"""


class TestMainText:
    def rows(self, spark, pages):
        docs = spark.createDataFrame([(i, u, h, "t", 1) for i, (u, h) in enumerate(pages)],
                                     "page_id long, url string, html string, text string, row int").repartition(3)
        out = html_suffix.extract_main_text(docs).collect()
        assert len(out) == len(pages) and all(r["n_chars"] == len(r["text"]) for r in out)
        assert all(r["url"] == pages[r["page_id"]][0] for r in out)
        return {r["page_id"]: r["text"] for r in out}

    def test_markup_names_the_article(self, spark):
        body = "<p>One &amp; two\n  three&nbsp;four<p><b>Bold</b> and <i>slanted</i>.<ul><li>x<li>y</ul><blockquote>Q</blockquote>"
        got = self.rows(spark, [("http://a.org/1", full_page("T &lt; 1", body)), ("http://a.org/2", None), ("http://a.org/3", ""),
                                (None, "<article><p>Cut off &am"), ("x", "<main><h2>M</h2>text<nav>no</nav> more</main>out"),
                                ("http://a.org/4", "<p>" * 3000 + "deep"), ("y", "a < b <article>c <d e")])
        assert got[0] == "T < 1\nOne & two three four\nBold and slanted.\nx\ny\nQ"
        assert got[1] == got[2] == ""
        assert got[3] == "Cut off &am"
        assert got[4] == "M\ntext\nmore"
        assert got[5] == "deep"

    def test_repeats_decide_without_an_article(self, spark):
        def page(k):
            return (f"<html><body><div>{MENU}</div><div>{NOTICE}</div><p>Story {k} tells of number {k} and what came of "
                    f"it in year {1900 + k}.</p><p>Second {k}.</p><div>{NOTICE}</div></body></html>")

        pages = [("http://h.org/%d" % k, page(k)) for k in range(5)] + [("http://alone.org/", page(9))]
        got = self.rows(spark, pages)
        for k in range(5):
            assert got[k] == f"Story {k} tells of number {k} and what came of it in year {1900 + k}.\nSecond {k}."
        assert MENU in got[5]

    def test_repeats_inside_an_article_stay(self, spark):
        body = f"<p>{NOTICE}</p><p>Own words {{}}</p>"
        got = self.rows(spark, [("http://h.org/%d" % k, full_page(f"Title {k}", body.format(k))) for k in range(4)])
        assert got[2] == f"Title 2\n{NOTICE}\nOwn words 2"

    def test_a_repeated_row_is_one_page(self, spark, frame):
        row = (1, "http://h.org/", f"<p>{NOTICE} {MENU}</p>")
        out = html_suffix.extract_main_text(frame("page_id long, url string, html string", [row, row])).collect()
        assert [r["text"] for r in out] == [f"{NOTICE} {MENU}"] * 2

    def test_copies_of_an_unmarked_page_keep_their_text(self, spark):
        def page(k, nav=""):
            return (f"<html><body>{nav}<div>{MENU}</div><p>Story {k} tells of number {k} and what came of it in year "
                    f"{1900 + k}.</p><div>{NOTICE}</div></body></html>")

        def story(k):
            return f"Story {k} tells of number {k} and what came of it in year {1900 + k}."

        # Copies only, one under another menu: nothing tells menu from story, so both stay.
        got = self.rows(spark, [("http://h.org/a", page(1)), ("http://h.org/b", page(1, f"<nav>Here {MENU}</nav>"))])
        assert got == {k: f"{MENU}\n{story(1)}\n{NOTICE}" for k in (0, 1)}
        # A third page of other content tells them apart.
        got = self.rows(spark, [("http://h.org/a", page(1)), ("http://h.org/b", page(1)), ("http://h.org/c", page(2))])
        assert got == {0: story(1), 1: story(1), 2: story(2)}

    def test_pages_without_a_host_are_not_pooled(self, spark):
        pages = [(url, f"<div>{NOTICE}</div><p>Page {k}</p>") for k, url in enumerate([None, "", "no scheme", "http:///x"])]
        got = self.rows(spark, pages)
        assert got == {k: f"{NOTICE}\nPage {k}" for k in range(4)}

    def test_windows_equal_a_real_suffix_array(self, spark):
        rng = random.Random(3)
        streams = {p: [rng.choice("abc") for _ in range(rng.randint(0, 60))] for p in range(12)}
        depth = 5
        rows = [(p, "h", str(p), html_suffix.window_ranks(html_suffix._token_hashes(" ".join(t)), depth).tolist(), ["x"])
                for p, t in streams.items()]
        parsed = spark.createDataFrame(rows, "row long, host string, page_id string, ranks array<long>, undecided array<string>")
        got = {r["row"]: {i for p in r["covered"] for i in range(p, p + depth)}
               for r in html_suffix.covered_positions(parsed).collect()}
        assert {p: got.get(p, set()) for p in streams} == brute.suffix_cover(streams, depth)

    def test_query_reads_every_page(self, spark):
        pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
        out = queries.op1_html_main_text(spark, SF_SMALL).collect()
        assert {r["page_id"] for r in out} == set(pages)
        assert all(r["text"] and "©" not in r["text"] for r in out)
        none = spark.read.parquet(f"{SF_SMALL}/pages.parquet").limit(0)
        assert html_suffix.extract_main_text(none).count() == 0


    def test_names_that_only_hold_a_frame_word_are_content(self, spark):
        body = ("<div id='ad-hoc-report'><p>Report.</p></div><p class='social-policy'>Policy.</p>"
                "<section class=comment-on-law>Law.</section><div class='ad-box'>Buy</div><div class='site-header ad'>Buy</div>"
                "<div class='related-posts'>More</div><p class='no-sidebar'>Wide.</p>")
        got = self.rows(spark, [("http://a.org/", f"<article>{body}</article>")])
        assert got[0] == "Report.\nPolicy.\nLaw.\nWide."

    def test_links_on_an_unmarked_page_are_left_to_the_repeats(self, spark):
        link = "<p><a href=x>Only a linked headline sentence here</a></p>"
        menu = "<ul>" + "".join(f"<li><a href=/{w}>{w}</a></li>" for w in MENU.split()) + "</ul>"
        got = self.rows(spark, [("http://a.org/1", link + "<p>One text.</p>"), ("http://b.org/1", menu + link),
                                ("http://b.org/2", menu + "<p>Other words.</p>")])
        assert got == {0: "Only a linked headline sentence here\nOne text.", 1: "Only a linked headline sentence here",
                       2: "Other words."}

    def test_inline_adverts_end_where_they_end(self, spark):
        cases = {
            '<p>Start <span class="ad"><span>Buy</span> now cheap</span> end</p>': "Start end",
            '<p>A <span class="ad">x<b>y<i>z</i></span> b <span hidden>no<span>no</span>no</span>c</p><p>d</p>': "A b c\nd",
            '<p>A <span class="ad">open ended</p><p>next</p>': "A\nnext",
            '<p>A <a class="ads"><div>block <p>inside</p></div> ad</a> b': "A\nb",
            'x<span class="ad">y': "x",
        }
        for page, want in cases.items():
            assert "\n".join(t for z, t, _ in html_suffix.blocks_of(page) if z == "open") == want, page

    def test_random_pages_equal_their_construction(self, spark):
        """Pages built together with their text: blocks, inline marks and adverts, frames in and around the article."""
        rng = random.Random(11)
        word = lambda: rng.choice(["alpha", "béta", "&lt;tag&gt;", "x &amp; y", "漢字", "1 200", "don&#39;t"])
        plain = lambda h: h.replace("&lt;", "<").replace("&gt;", ">").replace("&amp;", "&").replace("&#39;", "'")

        def inline():
            parts, said = [], []
            for _ in range(rng.randint(1, 6)):
                w = word()
                kind = rng.randrange(5)
                if kind == 4:
                    tag = rng.choice(["span", "b", "a"])
                    parts.append(f'<{tag} class="{rng.choice(["ad", "ad-box", "share-links"])}">buy<{tag}> {w} </{tag}>now</{tag}>')
                    continue
                said.append(plain(w))
                parts.append(w if kind < 2 else f"<i>{w}</i>" if kind == 2 else f'<span class="ad-hoc">{w}<br></span>')
            return " \n".join(parts), " ".join(said)

        frame = lambda: rng.choice(["<nav><a>Home</a></nav>", '<div class="cookie-notice"><p>Ok?</p></div>', "<aside>Side</aside>",
                                    "<form>Name <input></form>", '<div class="ad"><div>Buy</div>!</div>', "<script>a<b</script>",
                                    '<ul class="social-share"><li>Like</ul>', "<style>p{}</style>", "<!-- <p>no</p> -->"])

        def article():
            parts, said = [], []
            for _ in range(rng.randint(1, 8)):
                if rng.random() < 0.3:
                    parts.append(frame())
                h, t = inline()
                shape = rng.choice(["<p>{}</p>", "<p>{}", "<h2>{}</h2>", "<div class='social-policy'>{}</div>", "<ul><li>{}</ul>",
                                    "<blockquote><p>{}</p></blockquote>", "<table><tr><td>{}</table>"])
                parts.append(shape.format(h))
                said += [t] if t else []
            return "".join(parts), "\n".join(said)

        pages, want = [], {}
        for k in range(150):
            h, t = article()
            around = rng.choice(["<article>{}</article>", '<main><div class="content">{}</div></main>',
                                 '<div class="post"><article>{}</article><section id="comments"><p>Hi</p></section></div>'])
            pages.append((f"http://h{k % 7}.org/{k}", "<html><body>" + frame() + around.format(h) + frame() + "<footer>F</footer>"))
            want[k] = t
        assert self.rows(spark, pages) == want

    def test_marked_pages_go_through_the_repeats(self, spark):
        """The search covers articles and frames of marked pages; the check by markup comes after it."""
        menu = f"<nav>{MENU}</nav>"
        quoted = "<p>A passage that stands word for word in several articles of this one site.</p>"
        pages = [(1, "http://h.org/1", f"{menu}<article>{quoted}<p>First.</p></article>"),
                 (2, "http://h.org/2", f"{menu}<article><p>Second.</p>{quoted}</article>"),
                 (3, "http://h.org/3", f"<article><p>Third story.</p></article><div>{NOTICE}</div>"),
                 (4, "http://h.org/4", f"{quoted}<p>Fourth.</p><div>{NOTICE}</div>"),
                 (5, "http://other.org/", f"{menu}<article>{quoted}</article>"),
                 (6, None, f"{menu}<article>{quoted}</article>")]
        out = html_suffix.extract_main_text(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3))
        got = {r["page_id"]: r for r in out.collect()}
        said = quoted[3:-4]
        in_menu, in_passage, in_notice = (len(t.split()) - html_suffix.MIN_TOKENS + 1 for t in (MENU, said, NOTICE))
        assert {k: r["n_covered"] for k, r in got.items()} == {
            1: in_menu + in_passage, 2: in_menu + in_passage, 3: in_notice, 4: in_passage + in_notice, 5: 0, 6: 0}
        # What repeats in an article stays, also on the page without one; what repeats outside it goes.
        assert {k: r["text"] for k, r in got.items()} == {
            1: f"{said}\nFirst.", 2: f"Second.\n{said}", 3: "Third story.", 4: f"{said}\nFourth.", 5: said, 6: said}

    def test_searched_windows_hold_every_repeat(self, spark):
        """The filter by seeds loses no repeated window: articles against plain counting, over two hosts and several lots."""
        rng = random.Random(5)
        texts = {p: [rng.choice("abcd") for _ in range(rng.randint(0, 40))] for p in range(700)}
        pages = [(p, f"http://h{p % 2}.org/{p}", f"<article>{' '.join(t)}</article>") for p, t in texts.items()]
        out = html_suffix.extract_main_text(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(2))
        got = {r["page_id"]: r["n_covered"] for r in out.collect()}
        seen = {}
        windows = {p: [(p % 2, *t[i:i + html_suffix.MIN_TOKENS]) for i in range(len(t) - html_suffix.MIN_TOKENS + 1)]
                   for p, t in texts.items()}
        for p, found in windows.items():
            for w in found:
                seen.setdefault(w, set()).add(tuple(texts[p]))
        assert got == {p: sum(len(seen[w]) > 1 for w in found) for p, found in windows.items()}
        assert 0 < sum(got.values()) < sum(map(len, windows.values()))

    def test_lots_agree_with_plain_counting(self, spark):
        """Ids and contents that repeat within and across lots: a window needs two of each on its host."""
        rng = random.Random(8)
        texts = [" ".join(rng.choice("abcde") for _ in range(rng.randint(0, 30))) for _ in range(400)]
        rows = [(rng.choice([None, *range(900)]), f"http://h{rng.randrange(2)}.org/{k}", rng.choice(texts), rng.choice(texts))
                for k in range(2600)]
        pages = [(i, url, f"<nav>{nav}</nav><article>{text}</article>") for i, url, text, nav in rows]
        out = html_suffix.extract_main_text(spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(2))
        got = {r["url"]: r["n_covered"] for r in out.collect()}
        seen = {}
        depth = html_suffix.MIN_TOKENS
        windows = [[(url[:9], *t[j:j + depth]) for t in (text.split(), nav.split()) for j in range(len(t) - depth + 1)]
                   for _, url, text, nav in rows]
        for (i, url, text, _), found in zip(rows, windows):
            for w in found:
                ids, said = seen.setdefault(w, (set(), set()))
                ids.add(url if i is None else i)
                said.add(text)
        assert got == {r[1]: sum(min(map(len, seen[w])) > 1 for w in found) for r, found in zip(rows, windows)}

    def test_texts_are_written_once_and_not_shuffled(self, spark):
        """The blocks lie in buckets of lots; only positions are shuffled, and no frame that Spark runs shuffles a text."""
        rng = random.Random(2)
        pages = [(k, f"http://h{k % 3}.org/{k}", f"<nav>{MENU}</nav><article>{' '.join(rng.choice(MENU.split()) + str(rng.random()) for _ in range(50))}"
                  "</article>") for k in range(60)]
        before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        ran = spark._jsparkSession.sharedState().statusStore()
        first = ran.executionsCount()
        try:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
            out = html_suffix.extract_main_text(spark.createDataFrame(pages, "page_id long, url string, html string"))
            assert out.count() == 60
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        ends = ran.executionsCount()
        plans = [ran.executionsList(i, 1).apply(0).physicalPlanDescription() for i in range(first, ends)]
        moved = [x for plan in plans for x in re.findall(r"\) Exchange\nInput \[\d+\]: (.*)", plan)]
        assert moved and not [x for x in moved if re.search("article|undecided|html", x)]

    def test_columns_for_a_shuffle_come_back(self):
        packs = [(np.arange(n, dtype="<u8") << np.uint64(40), np.arange(n, dtype="<u2"), np.arange(n) % 2 == 0, -np.arange(n, dtype="<i8"))
                 for n in (0, 1, 700)]
        columns, sizes = html_suffix._loosened([html_suffix._squeezed(*x) for x in packs], "<u8", "<u2", "?", "<i8")
        assert list(sizes) == [0, 1, 700] and all((c == np.concatenate(x)).all() for c, x in zip(columns, zip(*packs)))

    def test_near_copies_of_an_unmarked_page(self, spark):
        """The repeats decide: shared windows go, what tells the copies apart stays with its surroundings under 8 tokens."""
        def page(k):
            return f"<div>{MENU}</div><p>Report {k}: the harbour was closed for repairs in the spring and opened again by June.</p>"

        got = self.rows(spark, [(f"http://h.org/{k}", page(k)) for k in (1, 2)] + [("http://other.org/", page(3))])
        assert got[2].endswith("by June.") and MENU in got[2]
        assert got[0] == "Report 1:" and got[1] == "Report 2:"


class TestWarc:
    ROWS = [(5, "http://b.org/x", "<p>" + "same " * 40), (3, "http://a.org/y?q#f", "<p>" + "same " * 40), (9, None, None),
            (8, "no\r\nscheme", "short"), (7, "http://a.org/y", "short"), (2, "http://A.org/z", "é" * 50), (4, "", "é" * 50),
            (11, "http://w.org/", "WARC/1.1\r\n\r\nContent-Length: 9\r\n\r\n" * 9), (6, "http://a.org/y", "x" * 99),
            (1, "http://a.org/y", "x" * 99), (20, "u://long", "y" * 300_000), (21, "u://long", "y" * 300_000)]

    def want(self, rows):
        first = {}
        for i, _, h in rows:
            b = (h or "").encode()
            if len(b) >= 100 and i is not None:
                first[b] = min(i, first.get(b, i))
        out = []
        for i, _, h in rows:
            b = (h or "").encode()
            ref = first.get(b) if first.get(b) not in (None, i) else None
            out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if ref is not None else "response", ref))
        return sorted(out, key=str)

    @pytest.mark.parametrize("per_file", [1, 3, 2000])
    def test_round_trip(self, spark, frame, per_file):
        pages = frame("page_id long, url string, html string, digest int, file int", [(*r, 1, 2) for r in self.ROWS])
        index = warc_index.archive_captures(pages, per_file)
        got = warc_index.resolve_revisits(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
        assert sorted((tuple(r) for r in got.collect()), key=str) == self.want(self.ROWS)
        keys = [(r["url_key"], r["captured"], r["page_id"]) for r in index.withColumn(
            "f", F.input_file_name()).orderBy("f").collect()]
        assert keys == sorted(keys)

    def test_files_are_cut_by_bytes(self, spark, frame):
        """Long records leave the files of short ones; no file of several records exceeds its bytes."""
        sizes = [10] * 300 + [3_000] * 60 + [30_000] * 20 + [400_000] * 3
        rows = [(i, f"http://h{i % 7}.org/{i}", chr(97 + i % 26) * n + str(i)) for i, n in enumerate(sizes)]
        pages = frame("page_id long, url string, html string", rows)
        path = shared_path(spark, "warc")
        warc_index.write_archives(pages.coalesce(1), path, 100, 200_000)
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).collect()
        held = [(f["length"], len(list(warc_index.read_records(f["content"])))) for f in files]
        assert sum(n for _, n in held) == len(sizes)
        assert all(n == 1 or (length <= 200_000 and n <= 100) for length, n in held)
        assert sum(n == 1 and length > 200_000 for length, n in held) == 3 and len(held) < 40
        index = warc_index.resolve_revisits(warc_index.archive_captures(pages, 100, 200_000))
        got = index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
        assert sorted((tuple(r) for r in got), key=str) == self.want(rows)

    def test_size_classes(self):
        for most, size in ((2000, 128 << 20), (1, 10), (9, 100)):
            classes = warc_index.size_classes(most, size)
            assert classes[0][0] == most and classes[-1][0] == 1 and all(n * b <= size for n, b in classes)

    def test_null_ids_and_empty_tables(self, spark, frame):
        rows = [(None, "http://a.b/", "z" * 200), (4, "http://a.b/", "z" * 200), (4, "http://a.b/", "z" * 200)]
        pages = frame("page_id long, url string, html string", rows)
        got = warc_index.resolve_revisits(warc_index.archive_captures(pages)).collect()
        assert sorted((str(r["page_id"]), r["record_type"], r["refers_to"], r["payload_bytes"]) for r in got) == [
            ("4", "response", None, 200), ("4", "response", None, 200), ("None", "revisit", 4, 200)]
        assert warc_index.archive_captures(pages.limit(0)).count() == 0

    def test_loser_tree(self):
        rng = random.Random(1)
        for k in (0, 1, 2, 3, 5, 8, 13):
            runs = [sorted(rng.randint(0, 50) for _ in range(rng.randint(0, 20))) for _ in range(k)]
            assert list(warc_index.LoserTree(runs, lambda x: x)) == sorted(x for r in runs for x in r)

    def test_bad_archives_are_errors(self):
        good = b"WARC/1.1\r\nContent-Length: 2\r\n\r\nab\r\n\r\n"
        assert [r[3] for r in warc_index.read_records(good * 2)] == [b"ab", b"ab"]
        for bad in (good[:-1], good + b"x", good.replace(b"h: 2", b"h: 1")):
            with pytest.raises(ValueError):
                list(warc_index.read_records(bad))
