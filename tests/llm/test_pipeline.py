"""The corpus pipeline against a plain version of its stages, and the entry without the subpackage."""

import hashlib
import random
import subprocess
import sys
from pathlib import Path

import public_tokenizers as public
import pytest
import tiktoken
from test_ngram_join import brute
from test_pii import plain_spans

import corpus_pipeline
from listmill.llm import bpe, pii
from listmill.llm.queries import RANKS

ROOT = Path(__file__).resolve().parents[2]
WORDS = {"en": "the cat and dog went to house with thing they wanted then left again".split(),
         "de": "der hund und die katze gingen nicht in das haus mit dem ding sie wollten wieder".split()}
ITEM = "the old fence by the river was painted red and green by seven men who came from far away"


def corpus():
    r = random.Random(8)
    rows = []
    for k in range(120):
        lang = r.choice(["en", "de"])
        text = [r.choice(WORDS[lang]) + r.choice(["", "s", "en", "er"]) for _ in range(r.randint(30, 80))]
        if k % 4 == 0:
            text.insert(r.randrange(len(text)), r.choice(["ann@mail.example.com", "10.20.30.40", "bob.k7@mail.example.org"]))
        rows.append((k, " ".join(text), lang))
    for k in range(120, 150):  # near copies of some
        words = rows[k - 120][1].split()
        words[r.randrange(len(words))] = "other"
        rows.append((k, " ".join(words), "en"))
    rows += [(150, rows[0][1], "en"), (151, None, "en"), (152, "", None), (153, "12 34 56", "de"), (154, "日本語のテキスト", None)]
    rows += [(160 + k, f"{rows[5 + k][1]} . {ITEM} . {rows[9 + k][1]}", "en") for k in range(4)]
    return rows


def plain(rows):
    """doc_id, masked text and digests of what should come out."""
    kept = [(k, t) for k, t, _ in rows if t and any(c.isascii() and c.isalpha() for c in t)]
    kept = [(k, t) for (k, t), (_, _, root) in zip(kept, brute(kept, 5, 80), strict=True) if k == root]
    kept = [(k, t) for k, t in kept if ITEM not in t]
    ranks = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=bpe.ranks_of(bpe.read_file(RANKS)), special_tokens={})
    out = []
    for key, text in kept:
        for kind, a, b in sorted(plain_spans(text), key=lambda s: -s[1]):
            text = f"{text[:a]}<{pii.KINDS[kind]}>{text[b:]}"
        ids = ranks.encode_ordinary(text)
        out.append((key, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    return out


@pytest.fixture(scope="module")
def folder(documents, spark, tmp_path_factory):
    where = str(tmp_path_factory.mktemp("tables"))
    documents(corpus()).write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")
    return where


def test_run_equals_the_plain_version(spark, folder):
    found = corpus_pipeline.run(spark, folder).collect()
    assert sorted(tuple(r) for r in found) == sorted(plain(corpus()))


def test_stages_keep_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "ngram_jaccard", "decontamination", "personal_data", "byte_bpe"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns


def test_empty_documents(spark, documents, folder):
    empty = documents([])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).count() == 0


def test_the_entry_works_without_the_subpackage(tmp_path):
    for name in ("__spark_entry__.py", "listmill"):
        (tmp_path / name).symlink_to(ROOT / name)
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith('listmill.llm'):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert 'listing_view' in e.queries() and not any(q.startswith('op') for q in e.queries()) and 'pipeline' not in e.queries()\n"
        "assert 'listing_view' in e.oracle_sql()\n"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PYTHONPATH": str(tmp_path), "PATH": "/usr/bin"}, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    code = "import __spark_entry__ as e; assert sum(q.startswith('op') for q in e.queries()) == 13 and 'pipeline' in e.queries()"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
