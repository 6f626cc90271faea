import hashlib
from collections import defaultdict

import pytest

from tallyloom.llm import mixing
from tallyloom.llm.queries import MIX


def share(given, children):
    """Water-filling by repetition: full children leave, the rest is divided anew."""
    out, open_ = {}, dict(children)
    while open_:
        weight = sum(w for _, w in open_.values())
        full = {k: room for k, (room, w) in open_.items() if room <= given * w / weight}
        if not full:
            return out | {k: given * w / weight for k, (_, w) in open_.items()}
        out |= full
        given -= sum(full.values())
        for k in full:
            del open_[k]
    return out


def brute(rows, mix):
    leaves = defaultdict(list)
    for r in rows:
        source, lang = r["source"] or "", r["lang"] or ""
        leaves[mix.domain_of.get(source, "other"), lang, source].append((r["doc_id"], len((r["text"] or "").split())))
    supply = {k: sum(n for _, n in v) for k, v in leaves.items()}
    weight = lambda level, name: (mix.domains, mix.langs, mix.sources)[level].get(name, mix.default)
    room = defaultdict(float)
    for k, n in supply.items():
        if n and all(weight(i, k[i]) > 0 for i in range(3)):
            for depth in range(4):
                room[k[:depth]] += n * mix.max_epochs
    granted = {(): room[()] / mix.max_epochs * mix.budget_share}
    for depth in range(3):
        for parent in [k for k in room if len(k) == depth]:
            children = {k: (room[k], weight(depth, k[-1])) for k in room if len(k) == depth + 1 and k[:depth] == parent}
            granted |= share(granted[parent], children)
    taken = []
    for leaf, docs in leaves.items():
        budget = granted.get(leaf, 0)
        if not supply[leaf] or leaf not in granted:
            continue
        epochs = int(budget // supply[leaf])
        part = budget - epochs * supply[leaf]
        by_key = defaultdict(list)
        for doc, n in docs:
            by_key[hashlib.md5(f"{mix.seed}-{epochs}-{'' if doc is None else doc}".encode()).hexdigest()].append((doc, n))
        prefix, total = set(), 0
        for key in sorted(by_key):
            total += sum(n for _, n in by_key[key])
            if total > part:
                break
            prefix.add(key)
        for key, group in by_key.items():
            for doc, n in group:
                taken += [(doc, *leaf, n, e) for e in range(epochs + (key in prefix))]
    return sorted(taken, key=repr)


MIXES = [
    MIX,
    mixing.Mix(budget_share=1.5, max_epochs=2),
    mixing.Mix(langs={"en": 0.05, "fr": 10.0}, sources={"src1": 0.0}, budget_share=0.9, max_epochs=3, domain_of=MIX.domain_of),
    mixing.Mix(budget_share=5.0, max_epochs=2),
]


@pytest.mark.parametrize("mix", MIXES, ids=range(len(MIXES)))
def test_against_brute_force(documents, odd, listed, mix):
    for docs in (documents, odd):
        got = sorted((tuple(r) for r in mixing.mixture(docs, mix).collect()), key=repr)
        assert got == brute([r.asDict() for r in docs.select("doc_id", "text", "lang", "source").collect()], mix)


def test_empty(nothing):
    assert mixing.mixture(nothing, MIX).count() == 0


def test_documents_keep_their_columns(odd, documents):
    mix = mixing.Mix(budget_share=0.5, max_epochs=1)
    taken = mixing.mixed_documents(documents, mix)
    want = sorted(r.doc_id for r in mixing.mixture(documents, mix).collect())
    assert taken.columns == documents.columns and sorted(r.doc_id for r in taken.collect()) == want
    assert mixing.mixed_documents(odd, mix).columns == odd.columns


def test_no_python(documents):
    assert "Python" not in mixing.mixture(documents, MIX)._jdf.queryExecution().executedPlan().toString()
