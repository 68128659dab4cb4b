"""Every operator against a brute-force version or an exact round trip, and on edge cases."""

import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers_llm import prose
from pyspark.sql import functions as F

from sessionloom.llm import (
    chat,
    decontamination,
    html_text,
    jaccard_join,
    packing,
    pii,
    quality,
    substring_dedup,
    token_counts,
    token_ids,
    toxicity,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def removed_by_hand(texts, size):
    rows = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(r[k : k + size]) for r in rows for k in range(len(r) - size + 1))
    out = []
    for r in rows:
        gone = [False] * len(r)
        for k in range(len(r) - size + 1):
            if seen[tuple(r[k : k + size])] > 1:
                gone[k : k + size] = [True] * size
        out.append((len(r), sum(gone), " ".join(w for w, g in zip(r, gone) if not g)))
    return Counter(out)


def test_windows_are_removed_as_by_hand(spark, edge_docs, no_docs):
    found = substring_dedup.remove_repeated_windows(edge_docs, size=5).collect()
    texts = [r.text for r in edge_docs.collect()]
    assert Counter((r.n_words, r.n_removed, r.kept) for r in found) == removed_by_hand(texts, 5)
    for r in found:
        assert sum(s.end - s.start for s in r.removed) == r.n_removed
    assert substring_dedup.remove_repeated_windows(no_docs).count() == 0


def near_copies():
    base = prose(7, 400).split()
    rows = [(100 + k, " ".join(w if j != 13 * k % 400 else f"edit{k}" for j, w in enumerate(base))) for k in range(30)]
    chain = [prose(9, 200).split()]
    for k in range(6):
        chain.append([f"step{k}" if 20 * k <= j < 20 * k + 5 else w for j, w in enumerate(chain[-1])])
    return rows + [(300 + k, " ".join(w)) for k, w in enumerate(chain)] + [(400 + k, prose(13 + k)) for k in range(10)]


def classes_by_hand(rows):
    sets = []
    for _, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets.append({tuple(w[k : k + 4]) for k in range(max(len(w) - 3, 1))} if w else set())
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            o = len(sets[a] & sets[b])
            if o and 100 * o >= 85 * (len(sets[a]) + len(sets[b]) - o):
                group = [group[b] if g == group[a] else g for g in group]
    names = defaultdict(list)
    for g, (i, _) in zip(group, rows):
        if i is not None:
            names[g].append(i)
    return Counter((i, len(s), min(names[g], default=None)) for g, (i, _), s in zip(group, rows, sets))


def test_jaccard_classes_as_by_hand(spark, edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()] + near_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = jaccard_join.jaccard_classes(docs).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == classes_by_hand(rows)
    kept = jaccard_join.one_of_each_class(edge_docs)
    assert kept.columns == edge_docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 3, 4, 5, 6, 7, 8, 9, None])
    assert jaccard_join.jaccard_classes(no_docs).count() == 0


def test_quality_measures_and_order(spark, edge_docs, no_docs):
    docs = edge_docs.select("doc_id", "text").union(
        spark.createDataFrame([(20, "WOW!! " * 12), (21, "a b c d e a b c d e x\nl\nl\n l"), (22, "of of the the it it is is on on a a")], "doc_id long, text string")
    )
    rows = {r.doc_id: r for r in quality.judge(docs, ["doc_id"]).collect() if r.doc_id}
    assert (rows[21].n_words, rows[21].n_repeat_words, rows[21].n_dup_lines) == (14, 10, 1)
    for r in docs.where("doc_id is not null").collect():
        w = WORD.findall(r.text or "")
        seen = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        covered = {k + j for k in range(len(w) - 4) if seen[tuple(w[k : k + 5])] > 1 for j in range(5)}
        assert (rows[r.doc_id].n_words, rows[r.doc_id].n_repeat_words) == (len(w), len(covered))
        assert rows[r.doc_id].base_failed == (len(w) < 10 or 100 * len(covered) > 20 * len(w))
    assert not rows[20].kept and not rows[22].kept and not rows[3].kept and rows[7].kept
    rules = quality.default_rules()
    assert {r.name for r in quality.ordered(docs, rules)} == {r.name for r in rules}
    assert quality.judge(no_docs, ["doc_id", "kept"]).count() == 0


def test_substituted_benchmark_items_are_found(spark, edge_docs, no_docs):
    item = prose(17, 30).split()
    changed = ["zzz" if k % 7 == 3 else w for k, w in enumerate(item)]
    other = ["zzz" if k % 2 else w for k, w in enumerate(item)]
    docs = [(1, f"{prose(3)} {' '.join(item).upper()}, {prose(5)}"), (2, " ".join(changed)), (3, " ".join(other)), (4, prose(3))]
    benchmark = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(item)), (3, None), (4, "too short")], "item_id long, text string")
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    found = decontamination.benchmark_overlaps(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(d, i) for d in (1, 2) for i in (1, 2)}
    assert {r.doc_id: r.start for r in found} == {1: 60, 2: 0}
    clean = decontamination.without_contaminated(edge_docs, benchmark)
    assert clean.columns == edge_docs.columns and clean.count() == edge_docs.count()
    assert decontamination.benchmark_overlaps(no_docs, benchmark).count() == 0
    assert decontamination.benchmark_overlaps(docs, benchmark.where("false")).count() == 0


def test_surrogates_keep_identity_format_and_the_rest(spark, edge_docs, no_docs):
    text = (
        "Mr. Smith wrote to jo.doe@Site.com, JO.DOE@SITE.COM and Mrs. Maria Jones at 10.0.0.1; 10.0.0.2. "
        "Card 4111 1111 1111 1111 or 4111111111111111, +1 (743) 555-3824, Mr. Smith. Version 4.0. Госпожа Иванова"
    )
    docs = spark.createDataFrame([(1, text), (2, "10.0.0.1!")], "doc_id long, text string")
    one, two = (r.text for r in pii.replace_entities(docs, "key").orderBy("doc_id").collect())
    for known in ("Smith", "doe", "Jones", "10.0.0", "1111", "3824", "Иванова"):
        assert known not in one
    a, b = re.findall(r"\S+@\S+?\.com", one, re.I)
    assert b == a.upper()
    first, second = re.findall(r"\d+\.\d+\.\d+\.\d+", one)
    assert first != second and two == f"{first}!"
    grouped, plain = re.search(r"Card ([\d ]+) or (\d+)", one).groups()
    assert grouped.replace(" ", "") == plain and re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}", one) and "Version 4.0." in one
    names = re.findall(r"Mr\. (\w+)", one)
    assert names[0] == names[1] and names[0] in pii.NAMES["latin", "s"]
    assert one.split()[-1] in [f"{name}а" for name in pii.NAMES["cyrillic", "s"]]
    assert re.search(r"Mrs\. (\w+)", one).group(1) in pii.NAMES["latin", "f"]
    same = pii.replace_entities(edge_docs, "key")
    assert Counter(same.select("doc_id", "text").collect()) == Counter(edge_docs.select("doc_id", "text").collect())
    assert pii.replace_entities(no_docs, "key").count() == 0


def test_many_names_stay_distinct(spark):
    names = [f"Mr. {chr(65 + k % 26)}{chr(97 + k // 26)}son" for k in range(80)]
    docs = spark.createDataFrame([(k, n) for k, n in enumerate(names)], "doc_id long, text string")
    out = {r.doc_id: r.text for r in pii.replace_entities(docs, "key").collect()}
    assert len(set(out.values())) == 80 and not set(out.values()) & set(names)


def test_ids_lengths_and_pieces(spark, edge_docs, no_docs):
    tokenizers = pytest.importorskip("tokenizers")
    public = pytest.importorskip("public_tokenizers")
    tokenizer = tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    ids = {r.text or "": tokenizer.encode(r.text or "", add_special_tokens=False).ids for r in edge_docs.collect()}
    encode = token_ids.encoder(token_ids.vocabulary_path()).ids
    for odd in ["a  b", " x ", "a\n\nb", "don't, we'll.", "a\tb", "a b", "<|endoftext|>", "a <|endoftext|> b", "<|endoftext|><|endoftext|>c", "x\n<|endoftext|>", "é́ñ 12a\n"]:
        ids[odd] = tokenizer.encode(odd, add_special_tokens=False).ids
    for text, expected in ids.items():
        assert np.frombuffer(encode(text), np.uint16).tolist() == expected, text

    lengths = [len(ids[r.text or ""]) for r in edge_docs.collect()]
    summed = token_counts.with_running_sums(token_counts.length_histogram(edge_docs))
    for r in summed.collect():
        assert r.truncated_total == sum(min(n, r.n_tokens) for n in lengths)
        assert r.docs_longer == sum(n > r.n_tokens for n in lengths)
    for r in token_counts.at_limits(summed, [0, 7, 100, 10**6]).collect():
        assert r.truncated_total == sum(min(n, r.context_limit) for n in lengths)

    docs = [(k, prose(k + 2, 40 * (k % 9) + 1)) for k in range(60)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    pieces = packing.pack(frame, window=256, with_ids=True).collect()
    whole = {k: [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for k, t in docs}
    parts, used = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert zlib.crc32(np.array(p.ids, "<u4").tobytes()) == p.ids_crc32 and len(p.ids) == p.length
        assert p.doc_tokens == len(whole[p.doc_id])
        parts[p.doc_id].append((p.start, p.ids))
        used[p.sequence_id].append((p.offset, p.length))
    assert {k: [i for _, part in sorted(v) for i in part] for k, v in parts.items()} == whole
    for spans in used.values():
        ends = np.cumsum([n for _, n in sorted(spans)])
        assert [o for o, _ in sorted(spans)] == [0, *ends[:-1]] and ends[-1] <= 256 and ends[-1] & (ends[-1] - 1) == 0
    assert packing.pack(edge_docs).agg(F.sum("length")).first()[0] == sum(lengths) + len(lengths)
    assert packing.pack(no_docs).count() == 0 and token_counts.length_histogram(no_docs).count() == 0


def test_neighbours_follow_their_seed():
    rng = np.random.default_rng(1)
    topics = [rng.integers(1000 * k, 1000 * k + 300, 40).astype(np.uint16) for k in (1, 2, 3, 4) for _ in range(3)]
    docs = [topics[k] for k in (0, 3, 6, 9, 1, 4, 7, 10, 2, 5, 8, 11)]
    order = packing._order(docs, 120)
    assert [int(docs[k][0]) // 1000 for k in order[:3]] == [1, 1, 1]


def test_automaton_is_the_edit_distance():
    automaton = toxicity.Automaton(["idiot", "moron"])
    assert [automaton.match(w) for w in ("idiot", "idiots", "idot", "idxot", "idiiot", "mxron", "the", "", "idi")] == [1, 1, 2, 2, 2, 2, 0, 0, 0]


def test_toxicity_on_held_out_rows(spark, edge_docs, no_docs):
    rows = [(k, f"{prose(k % 50 + 2)} {'you are a moron' if k % 3 == 0 else 'fine day'} {k}") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(300)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    scores = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert all((scores[k] >= 0.5) == (k % 3 == 0) for k in range(300) if toxicity.in_fold(k))
    assert toxicity.score(edge_docs, model).count() == edge_docs.count()
    assert toxicity.score(no_docs, toxicity.fit(no_docs, labels.where("false"))).count() == 0


def test_main_text_of_all_layouts():
    for page in html_text.labelled_pages():
        text = html_text.main_text(re.sub(r' data-content="."', "", page))
        assert "Title of the story" in text and "Entry" not in text and "Comments" not in text and "cookies" not in text
    assert html_text.main_text(None) == "" == html_text.main_text("") == html_text.main_text("<nav><a>x")
    deep = "<div>" * 5000 + "<p>deep text of some length</p>"
    assert isinstance(html_text.main_text(deep), str)
    assert html_text.main_text("<article><h1>A &amp; B</h1><p>one<b>two</b>\n three</p><script>x<p></script><p>Yes.") == "A & B\nonetwo three\nYes."


def test_pages_as_rows(spark):
    pages = spark.createDataFrame([(1, "u", None), (1, "u", None), (2, None, "<article><p>A b c.</p></article>")], "page_id long, url string, html string")
    rows = sorted((r.page_id, r.text, r.n_chars) for r in html_text.extract(pages).collect())
    assert rows == [(1, "", 0), (1, "", 0), (2, "A b c.", 6)]
    assert html_text.extract(pages.where("false")).count() == 0


def test_quotes_link_replies(spark):
    rows = [
        (1, 0, "u", "Hello there, a question.\nSecond line."), (1, 1, "a", "On Monday u wrote:\n> Hello  there, a QUESTION\nAn answer."),
        (1, 2, "u", "> > hello there a question\n> An answer.\nThanks"), (1, 3, "u", "else"), (2, 0, "u", "> An answer.\nelsewhere"),
        (None, 1, "x", "> y"), (3, 0, None, None), (3, 0, None, ""), (4, 0, "u", "> nobody said it"),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = Counter((r.conv_id, r.turn, r.text, r.reply_conv, r.reply_turn, r.thread_conv, r.thread_turn, r.depth) for r in chat.reply_ordered(frame).collect())
    assert found == Counter([
        (1, 0, "Hello there, a question.\nSecond line.", None, None, 1, 0, 0), (1, 1, "An answer.", 1, 0, 1, 0, 1),
        (1, 2, "Thanks", 1, 1, 1, 0, 2), (1, 3, "else", None, None, 1, 3, 0), (2, 0, "elsewhere", 1, 1, 1, 0, 2),
        (None, 1, "", None, None, None, 1, 0), (3, 0, "", None, None, 3, 0, 0), (3, 0, "", None, None, 3, 0, 0), (4, 0, "", None, None, 4, 0, 0),
    ])
    assert chat.reply_ordered(frame.where("false")).count() == 0


def replacements_needed(masks, longest):
    """For every length, the fewest replaced words that touch every placement of every mask."""
    span = max(map(len, masks))
    bits = [(len(m), int(m, 2)) for m in masks]
    best, out = {0: 0}, {}
    for length in range(1, longest + 1):
        following = {}
        for state, count in best.items():
            for replaced in (0, 1):
                now = (state << 1 | replaced) & ((1 << span) - 1)
                if all(length < n or now & b for n, b in bits):
                    following[now] = min(following.get(now, 10**9), count + replaced)
        best = following
        out[length] = min(best.values())
    return out


def test_masks_leave_no_overlap_out():
    allowed = {n: n * (100 - decontamination.SHARE) // 100 for n in range(1, 401)}
    needed = replacements_needed(decontamination.MASKS, 400)
    assert all(needed[n] > allowed[n] for n in range(7, 401))
    for n, masks in decontamination.SHORT_MASKS.items():
        assert replacements_needed(masks, n)[n] > allowed[n]


def test_every_substitution_in_short_items_is_found(spark):
    items = [(n, " ".join(f"i{n}w{k}" for k in range(n))) for n in range(1, 13)] + [(90, None), (91, " - "), (92, "")]
    rows, expected = [], set()
    for n, item in items[:12]:
        for gone in range(n + 1):  # the last one replaces nothing
            words = [w if k != gone else "other" for k, w in enumerate(item.split())]
            rows.append((len(rows), f"before {' '.join(words)} after"))
            if n * 80 <= 100 * (n - (gone < n)):
                expected.add((len(rows) - 1, n))
    rows += [(1000, None), (1001, ""), (1002, "- -")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, row int, offset int")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.benchmark_overlaps(docs, benchmark)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == expected
    kept = decontamination.without_contaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert {(r.doc_id, r.row, r.offset) for r in kept.collect()} == {(i, 1, 2) for i, _ in rows} - {(i, 1, 2) for i, _ in expected}
    assert decontamination.benchmark_overlaps(docs, benchmark.where("false")).count() == 0


def replaced_texts(spark, *texts):
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    return [r.text for r in pii.replace_entities(docs, "key").orderBy("doc_id").collect()]


def test_people_stay_the_same_people(spark):
    first, second, third = replaced_texts(
        spark,
        "Dr. Anna Schmidt met Mr. John Smith. Schmidt said John Smith and Anna left in Smith's car.",
        "Mr Smith asked Mrs Jane O'Neil; O'Neil and Frau Schmidt agreed.",
        "Schmidt, Smith and Anna are not people here.",
    )
    words = re.match(r"Dr. (\S+) (\S+) met Mr. (\S+) (\S+)\. (\S+) said (\S+) (\S+) and (\S+) left in (\S+)'s car.", first).groups()
    anna, schmidt, john, smith = words[:4]
    assert words[4:] == (schmidt, john, smith, anna, smith)
    assert len({anna, schmidt, john, smith, "Anna", "Schmidt", "John", "Smith"}) == 8
    found = re.match(r"Mr (\S+) asked Mrs (\S+) (\S+); (\S+) and Frau (\S+) agreed.", second).groups()
    assert found[0] == smith and found[2] == found[3] != "O'Neil" and found[4] == schmidt
    assert third == "Schmidt, Smith and Anna are not people here."


def test_other_formats(spark):
    texts = ["call 13812345678.", "030 1234567", "07911 123456", "at fe80::1ff:fe23:4567:890a now", f"key {'abcdef' * 6} end"]
    for text, new in zip(texts, replaced_texts(spark, *texts)):
        assert new != text and len(new) == len(text)
        assert re.sub(r"[0-9a-f]", "0", new) == re.sub(r"[0-9a-f]", "0", text)


def test_formats_do_not_run_out(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    mails = [f"{a}@{b}.de" for a in letters for b in letters]
    addresses = [f"{k // 1000}.{k // 100 % 10}.{k // 10 % 10}.{k % 10}" for k in range(10_000)]
    out = replaced_texts(spark, *mails, *addresses)
    assert len(set(out)) == len(out) and not set(out) & set(mails + addresses)
    assert all(re.fullmatch(r"[a-z]+@[a-z]+\.de", m) for m in out[: len(mails)])
    assert all(re.fullmatch(r"\d+(\.\d+){3}", a) and max(map(int, a.split("."))) < 256 for a in out[len(mails) :])


def test_personal_data_beside_clashing_columns(spark):
    docs = spark.createDataFrame([("me@x.org", 1, "n", 7, "g", 5, "p")], "text string, __row int, __new string, `a.b` int, __gaps string, n_entities int, body string")
    (row,) = pii.replace_entities(docs, "key").collect()
    assert (row["__row"], row["__new"], row["a.b"], row["__gaps"], row["n_entities"], row["body"]) == (1, "n", 7, "g", 1, "p")


BODY = "<h1>T</h1>" + "<p>" + "Some long text of the story, which goes on for a while. " * 5 + "</p><p>Short.</p>"


def test_comments_inside_articles_are_left_out():
    for box in ("<div class='comment-box'><p>Reader says hi</p></div>", '<section id="comments"><ul><li>Reader says hi</li></ul></section>'):
        text = html_text.main_text(f"<body><nav><a href='/'>x</a></nav><article>{BODY}{box}</article></body>")
        assert "Reader" not in text and text.endswith("Short.")


def test_quotes_in_attributes():
    for tag in ("<p title=it's>", "<p title=\"a>b\">", "<p title='a>b' x>", "<p data-x=\"open>", "<p a=1 b=' c>"):
        text = html_text.main_text(f"<article>{BODY}{tag}First here</p><p>We don't know, \"he\" said.</p></article>")
        assert text.endswith("Short.\nFirst here\nWe don't know, \"he\" said."), tag


def test_many_tags_take_little_time():
    started = time.perf_counter()
    html_text.main_text("<div>" * 8000 + "</span>" * 100_000)
    html_text.main_text("<b>" * 20_000 + "<p>x" * 20_000)
    assert time.perf_counter() - started < 10


def test_held_out_layouts():
    """Each kind of main part held out in turn: the share of elements with text that is told right."""
    pages = html_text.labelled_pages()
    ends = len(html_text._ENDS)
    shares = []
    for held in range(len(html_text._MAINS)):
        chosen = [k // ends % len(html_text._MAINS) == held for k in range(len(pages))]
        model = html_text.Model([page for page, out in zip(pages, chosen) if not out])
        right = every = 0
        for source in [page for page, out in zip(pages, chosen) if out][:10]:
            page, labels = html_text.Page(source), [0]
            for node in range(1, len(page.tags)):
                mark = html_text._LABEL.search(page.attributes[node])
                labels.append(int(mark[1]) if mark else labels[page.parents[node]])
            odds = model.marginals(page)
            for node in {node for node, _ in page.blocks}:
                every, right = every + 1, right + ((odds[node] > 0) == labels[node])
        shares.append(right / every)
    assert sum(shares) / len(shares) > 0.9, shares
