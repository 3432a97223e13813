import hashlib
import random
import re
from collections import Counter

import pytest

from tidebook.llm import substring_dedup
from tidebook.llm.queries import repeat_digests
from tidebook.llm.substring_dedup import cut_repeats


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_force(rows, window=35):
    counts = Counter()
    for _, text in rows:
        words = words_of(text)
        counts.update(tuple(words[i : i + window]) for i in range(len(words) - window + 1))
    out = []
    for doc_id, text in rows:
        words = words_of(text)
        gone = set()
        for i in range(len(words) - window + 1):
            if counts[tuple(words[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc_id, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(docs):
    rows = repeat_digests(cut_repeats(docs, as_text=False)).collect()
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in rows), key=repr)


def test_whole_small_table(small_documents):
    rows = [(r.doc_id, r.text) for r in small_documents.collect()]
    assert found(small_documents) == brute_force(rows)


def fixture(seed=5):
    rng = random.Random(seed)
    passages = [" ".join(f"p{k}w{rng.randrange(50)}" for _ in range(rng.choice([34, 35, 36, 50, 120]))) for k in range(8)]
    texts = []
    for i in range(60):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            parts.append(" ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(40))))
            if rng.random() < 0.7:
                words = rng.choice(passages).split()
                a = rng.randrange(3)
                parts.append("\t".join(words[a : len(words) - rng.randrange(3)]))
        texts.append("\n".join(parts))
    texts += ["x " * 34, "x " * 35, "x " * 36, "y " * 36, " ".join("ab" * 40), None, "", "  ", "é " * 70]
    texts += [" ".join(map(str, range(35)))] * 2 + [" ".join(map(str, range(34)))] * 2
    return texts


def test_against_brute_force(documents):
    texts = fixture()
    assert found(documents(texts)) == brute_force(list(enumerate(texts, 1)))


def test_split_seeds_and_a_full_filter(documents, monkeypatch):
    """Seeds dealt over several tasks, and a filter that lets everything pass."""
    monkeypatch.setattr(substring_dedup, "BROADCAST_SEEDS", 0)
    monkeypatch.setattr(substring_dedup, "SHARE", 3)
    monkeypatch.setattr(substring_dedup, "FILTER_BITS", 64)
    texts = fixture(6) + fixture(6)[:5] * 4
    assert found(documents(texts)) == brute_force(list(enumerate(texts, 1)))


def test_repeated_rows_and_null_ids(documents):
    text = " ".join(map(str, range(40)))
    rows = [(1, text), (1, text), (None, "a"), (None, text + " end"), (4, None)]
    docs = documents([t for _, t in rows], [i for i, _ in rows])
    assert found(docs) == brute_force(rows)


def test_texts_keep_their_blanks(documents):
    passage = " ".join(map(str, range(40)))
    texts = [f" head\n\n{passage}\n tail  end\n", f"{passage} a\tb", "clean \n text ", passage, None]
    got = {r.doc_id: (r.text, r.n_removed, r.source) for r in cut_repeats(documents(texts)).collect()}
    assert got == {
        1: ("head\n\ntail  end", 40, "src0"),
        2: ("a\tb", 40, "src1"),
        3: ("clean \n text ", 0, "src2"),
        4: ("", 40, "src0"),
        5: (None, 0, "src1"),
    }


def test_empty_table_and_clashing_names(documents):
    docs = documents(["a b"])
    assert cut_repeats(docs.limit(0)).collect() == []
    odd = docs.selectExpr("*", "'k' AS key", "1 AS spans", "2 AS n_words", "3 AS n", "4 AS seed", "5 AS first")
    row = cut_repeats(odd).first()
    assert (row.text, row.n_words, row.n, row.seed, row["first"]) == ("a b", 2, 3, 4, 5)
    assert cut_repeats(odd).columns == [*docs.columns, "n", "seed", "first", "n_words", "n_removed"]


@pytest.mark.parametrize("window,seed", [(35, 35), (35, 1), (8, 3)])
def test_other_lengths(documents, window, seed):
    texts = fixture(7)
    docs = repeat_digests(cut_repeats(documents(texts), window, seed, as_text=False))
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in docs.collect()), key=repr)
    assert got == brute_force(list(enumerate(texts, 1)), window)
