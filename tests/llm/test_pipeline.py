"""The pipeline stage by stage against plain versions, each on what the stage before it kept."""

import random
import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from helpers_llm import prose
from test_jaccard_classes import classes_by_hand
from tokenizers import Tokenizer

import corpus_pipeline
from sessionloom.workspace import materialize

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, __row int, kept string"


def item_words(text):
    return re.sub(r"[\W_]+", " ", (text or "").lower()).split()


def contaminated(text, items):
    """Whether four fifths of some item's words stand at their places somewhere."""
    held = item_words(text)
    for item in items:
        wanted = item_words(item)
        for offset in range(-len(wanted) + 1, len(held)):
            same = sum(0 <= offset + k < len(held) and held[offset + k] == w for k, w in enumerate(wanted))
            if wanted and same * 5 >= len(wanted) * 4:
                return True
    return False


def rejected(text):
    """The base rules, and those of the cascade, one after the other."""
    text = text or ""
    words, lines = WORD.findall(text), [line for line in text.split("\n") if WORD.search(line)]
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    seen = Counter(windows)
    repeated = {k + j for k, w in enumerate(windows) if seen[w] > 1 for j in range(5)}
    if len(words) < 10 or 100 * len(repeated) > 20 * len(words):
        return True
    letters = [c for c in text if c.isalpha()]
    return (
        100 * sum(c in "#*$%&|<>" for c in text) > 30 * len(words)
        or 100 * text.count("!") > 30 * len(words)
        or 2 * sum(c.isupper() for c in letters) > len(letters)
        or 2 * (len(lines) - len(set(lines))) > len(lines)
        or 100 * sum(a == b for a, b in zip(words, words[1:])) > 30 * len(words)
        or sum(map(len, words)) > 15 * len(words)
    )


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    rng = random.Random(3)
    items = [" ".join(f"item{k}word{j}" for j in range(12 + k)) for k in range(4)]
    texts = [None, "", " \n", "too few words", "WORDS IN CAPITAL LETTERS ONLY " + " ".join(f"UP{k}" for k in range(20))]
    texts += [" ".join(["same words again and again here now"] * 6), "! ".join(f"w{k}" for k in range(30)), "# $ % & " * 12 + prose(4)]
    texts += [prose(k) for k in range(5, 25)]
    texts += [f"{prose(7)} extra", f"{prose(7)} other end", prose(7), prose(9).upper().lower()]
    for item in items:
        words = item.split()
        words[rng.randrange(len(words))] = "replaced"
        texts.append(f"{prose(40 + len(words))} {' '.join(words)} {prose(50)}")
    texts += [f"{prose(60)} write to jane.doe@mail.org or Dr. Anna Schmidt; Schmidt answers", f"{prose(61)} call +49 30 1234567"]
    texts.append(prose(62, 6000))
    rows = [(k if k % 11 else None, t, "en", None if k % 5 else f"s{k % 3}", len(t or ""), "r", 5, "k") for k, t in enumerate(texts)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    bench = [(k, item) for k, item in enumerate(items)] + [(90, None), (91, "")]
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, items


def test_every_stage(spark, tables):
    folder, items = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality rules", "n-gram Jaccard join", "benchmark decontamination", "PII", "packing"]

    def after(name, before):
        out = materialize(stages[name](spark, before, folder), "stage")
        if name != "packing":
            assert out.schema.simpleString() == docs.schema.simpleString()
        return out

    every = docs.collect()
    good = after("quality rules", docs)
    assert Counter(good.collect()) == Counter(r for r in every if not rejected(r.text))

    single = after("n-gram Jaccard join", good)
    kept, rows = Counter(single.collect()), good.collect()
    assert not kept - Counter(rows)
    classes = classes_by_hand([(k, r.text) for k, r in enumerate(rows)])
    members = defaultdict(list)
    for k, (_, name) in classes.items():
        members[name].append(rows[k])
    assert sum(kept.values()) == len(members)
    assert all(sum(kept[r] > 0 for r in set(group)) == 1 for group in members.values())

    clean = after("benchmark decontamination", single)
    assert Counter(clean.collect()) == Counter(r for r in single.collect() if not contaminated(r.text, items))

    private = after("PII", clean)
    texts = " ".join(r.text for r in private.collect())
    assert not re.search(r"jane|Schmidt|Anna|1234567", texts)
    touched = re.compile(r"jane|Schmidt|1234567")
    assert Counter(r for r in clean.collect() if not touched.search(r.text)) <= Counter(private.collect())
    assert all(r.n_chars == len(r.text) for r in private.collect() if touched.search(r.text))
    assert private.count() == clean.count()

    pieces = after("packing", private).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    wanted = Counter(tuple(tokenizer.encode(r.text, add_special_tokens=False).ids + [1]) for r in private.collect())
    sequences = defaultdict(dict)
    for p in pieces:
        assert len(p.ids) == p.length
        sequences[p.sequence_id][p.offset] = p
    for places in sequences.values():
        at = 0
        for offset in sorted(places):
            assert offset == at
            at += places[offset].length
        assert at == 2048 or at & (at - 1) == 0
    by_size = Counter((p.doc_id, p.doc_tokens) for p in pieces if p.start == 0)
    assert by_size == Counter((r.doc_id, len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1) for r in private.collect())
    whole = Counter(tuple(p.ids) for p in pieces if p.length == p.doc_tokens)
    assert not whole - wanted and sum(p.length for p in pieces) == sum(len(ids) * n for ids, n in wanted.items())


def test_run_is_the_stages_and_leaves_one_table(spark, tables):
    folder, _ = tables
    out = corpus_pipeline.run(spark, folder)
    assert out.agg({"length": "sum"}).first()[0] > 2000 and set(out.columns) >= {"doc_id", "ids", "sequence_id"}


def test_nothing_goes_through(spark, tables, tmp_path):
    folder, _ = tables
    empty = str(tmp_path / "empty")
    spark.read.parquet(f"{folder}/documents.parquet").where("false").write.parquet(f"{empty}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").where("false").write.parquet(f"{empty}/benchmark.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0
