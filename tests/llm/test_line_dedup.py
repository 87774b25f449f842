import random

from helpers import documents, empty_documents, odd_documents, prose
from keyweave.llm import line_dedup as d

RULE = d.Rule(min_docs=2, long_tokens=10, min_docs_short=3, min_tokens=3)


def brute(docs, rule):
    """Lines to drop by comparing every line with every earlier one of its template, and equal lines with one another."""
    kinds = {}
    for doc, text in sorted(docs, key=lambda x: x[0]):
        for i, line in enumerate((text or "").split("\n")):
            k = d.line_keys(line.encode(), rule)
            if k:
                n, leaf, pieces, constants = k
                widths = constants or [(j + 1) * n // len(pieces) - j * n // len(pieces) for j in range(len(pieces))]
                kind = kinds.setdefault((leaf, tuple(pieces)), [n, widths, []])
                kind[1] = min(kind[1], widths)
                kind[2].append((doc, i))
    groups, keeper = {}, {}

    def goes(n, ids):
        least = rule.min_docs if n >= rule.long_tokens else rule.min_docs_short if n >= rule.min_tokens else rule.bare_docs(len(docs))
        return len(set().union(*ids)) >= max(2, least)

    for (leaf, pieces), (n, widths, at) in kinds.items():
        for p in range(0, len(pieces), 2):
            groups.setdefault((leaf, p, pieces[p:p + 2]), []).append((min(at), pieces, n, widths, at))
        if goes(n, [{doc for doc, _ in at}]):
            keeper[leaf, pieces] = min(at)
    for (leaf, *_), members in groups.items():
        head = min(members)
        alike = [x for x in members if sum(w for w, a, b in zip(x[3], x[1], head[1]) if a == b) >= rule.constant * head[2]]
        if goes(head[2], [{doc for doc, _ in x[4]} for x in alike]):
            for x in alike:
                key = (leaf, x[1])
                keeper[key] = min(keeper.get(key, head[0]), head[0])
    return {(doc, i) for key, first in keeper.items() for doc, i in kinds[key][2] if (doc, i) != first}


def sql(rows):
    """What the registered SQL leaves of the documents."""
    import duckdb

    from keyweave.llm.queries import SQL
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    return sorted(db.execute(f"SELECT doc_id, text, n_lines_dropped FROM ({SQL['op5_line_dedup']})").fetchall())


def mixed_lines(seed):
    """Documents of lines that are shared, shared but for a few tokens, mostly masked, and numbers only."""
    rng = random.Random(seed)
    number = lambda: f"{rng.uniform(0, 100):.1f}"
    shared = [prose(2000 + i, 4 + 3 * i, 999) for i in range(6)] + ["12.5 3.1 99", "id 7 of 9 at 3 in 4 for 5 to 6 by 8"]
    rows = []
    for i in range(24):
        lines = prose(i).split("\n") + [" ".join(number() for _ in range(rng.choice([3, 12]))), f"row {number()} of alder {number()} birch {number()} cedar {number()} and {number()}"]
        for s in rng.sample(shared, 3):
            words = s.split()
            if rng.random() < 0.5:
                words[rng.randrange(len(words))] = rng.choice([number(), "changed", "<*>"])
            lines.insert(rng.randrange(len(lines)), " ".join(words))
        lines += rng.sample(["OK", "Read more", " ", "Page 7", "短い行", "間隔のない文章がここに続いて繰り返される" + "例" * (i % 3), str(rng.randrange(9))], 3)
        rows.append((i, "\n".join(lines)))
    return rows + [(100, rows[3][1])]


def test_sql_is_of_the_same_rule(spark):
    rows = mixed_lines(1)
    rule = d.Rule()
    dropped = brute(rows, rule)
    want = sorted((doc, "\n".join(x for i, x in enumerate(t.split("\n")) if (doc, i) not in dropped), sum(doc == a for a, _ in dropped)) for doc, t in rows)
    got = sorted((r.doc_id, r.text, r.n_lines_dropped) for r in d.drop_recurring_lines(documents(spark, rows)).collect())
    assert got == want == sql(rows) and dropped
    numbers = [(i, f"{i}.5 {i}.1 99\n1 2 {i} 4") for i in range(6)]
    assert sql(numbers) == [(i, t, 0) for i, t in numbers]


def test_a_document_counts_once_for_a_template(spark):
    line = "alder birch cedar dune ember fjord gorge {}"
    two = [(i, "\n".join(line.format(w) for w in ("kelp", "larch", "moor")) + f"\n{prose(i)}") for i in range(2)]
    five = two + [(2 + i, line.format("oak" * (i + 1))) for i in range(3)]
    for rows, gone in ((two, 0), (five, 8)):
        out = d.drop_recurring_lines(documents(spark, rows)).collect()
        assert sum(r.n_lines_dropped for r in out) == gone == len(brute(rows, d.Rule()))
        assert sorted((r.doc_id, r.text, r.n_lines_dropped) for r in out) == sql(rows)


def test_as_brute_force(spark):
    rng = random.Random(5)
    shared = [prose(1000 + i, 4 + 5 * i, 999) for i in range(8)]
    rows = []
    for i in range(60):
        lines = prose(i).split("\n")
        for s in rng.sample(shared, 3):
            words = s.split()
            if rng.random() < 0.5:
                words[rng.randrange(3, len(words))] = str(rng.randint(0, 10 ** 6))
            if rng.random() < 0.3:
                words[-1] = "changed"
            lines.insert(rng.randrange(len(lines)), " ".join(words))
        rows.append((i, "\n".join(lines)))
    rows += [(100, rows[3][1]), (101, rows[3][1])]
    found = d.recurring_lines(documents(spark, rows).repartition(4), RULE).collect()
    assert {(r.kw_id, i) for r in found for i in r.kw_lines} == brute(rows, RULE) != set()


def test_passages_go_and_clean_documents_stay(spark):
    passage = " ".join(prose(77, 60, 60).split())
    rows = [(i, prose(i) + "\n" + (passage if i % 3 == 0 else "") + "\n" + prose(500 + i)) for i in range(30)]
    out = {r.doc_id: r for r in d.drop_recurring_lines(documents(spark, rows)).collect()}
    assert sum(passage in r.text for r in out.values()) == 1 and passage in out[0].text
    for i, text in rows:
        assert out[i].text == text if i % 3 else out[i].text in (text, text.replace("\n" + passage, ""))
        assert out[i].n_lines_dropped == (i % 3 == 0 and i > 0)


def test_variable_fields_are_generalised(spark):
    rows = [(i, f"user {i} logged in from host h{i} at 10:{i:02d} and stayed for a while until noon") for i in range(5)]
    out = {r.doc_id: r.text for r in d.drop_recurring_lines(documents(spark, rows)).collect()}
    assert [i for i, t in out.items() if t] == [0]


def test_repeats_within_one_document_stay(spark):
    text = "\n".join(["all the same words in each line of this text here"] * 4)
    out = d.drop_recurring_lines(documents(spark, [(1, text), (1, text), (2, prose(3))])).collect()
    assert all(r.n_lines_dropped == 0 for r in out) and sorted(r.text for r in out) == sorted([text, text, prose(3)])


def test_odd_rows(spark):
    docs = odd_documents(spark)
    out = d.drop_recurring_lines(docs)
    assert set(out.columns) == set(docs.columns) and out.count() == docs.count()
    assert out.where("text is null").count() == docs.where("text is null").count()
    kept = [r.text for r in out.collect()]
    assert sum(t == prose(1) for t in kept) in (1, 2)
    assert prose(2) + "\r\n\r\n" + prose(3) in kept and "x" * 200_000 in kept
    assert d.drop_recurring_lines(empty_documents(spark)).isEmpty()


def test_rows_that_share_an_id_lose_their_own_lines_only(spark):
    common = " ".join(prose(40, 12).split())
    own = [" ".join(prose(50 + i, 12).split()) for i in range(6)]
    rows = [(0, common), (None, own[0] + "\n" + common), (None, common + "\n" + own[1]), (None, own[2] + "\n" + own[3]),
            (7, own[4] + "\n" + common), (7, common + "\n" + own[5])]
    out = d.drop_recurring_lines(documents(spark, rows)).collect()
    assert sorted(r.text for r in out) == sorted(["", own[0], common + "\n" + own[1], own[2] + "\n" + own[3], own[4], own[5]])
    assert sorted(r.n_lines_dropped for r in out) == [0, 0, 1, 1, 1, 1]  # the null id is the least


def test_masked_tokens_are_no_agreement(spark):
    rng = random.Random(9)
    number = lambda: f"{rng.uniform(0, 100):.2f}"
    tables = [[" ".join(number() for _ in range(n)) for n in (3, 12, 16)] + [f"row {number()} of {number()} at {number()} alder {number()} birch {number()} cedar {number()}"]
              for _ in range(8)]
    copied = " ".join(number() for _ in range(12))
    rows = [(i, "\n".join([*lines, copied])) for i, lines in enumerate(tables)]
    out = {r.doc_id: r for r in d.drop_recurring_lines(documents(spark, rows)).collect()}
    for i, text in rows:
        assert out[i].text == (text if i == 0 else "\n".join(tables[i])) and out[i].n_lines_dropped == (i > 0)


def test_equal_lines_recur_whatever_lines_come_first(spark):
    rng = random.Random(3)
    texts = []
    for _ in range(60):  # few openings, middles and ends, so that lines unlike each other share every pair of pieces
        parts = [rng.choice(["oak", "elm", "ash"]), rng.choice(["kelp moor", "dune fjord", "heath inlet"]), rng.choice(["cedar larch", "pine nettle", "birch alder"])]
        texts.append("all rights are " + " ".join(parts + [f"{rng.choice('abc')} {rng.choice('abc')} {rng.choice('abc')} {rng.choice('abc')}"]))
    rows = list(enumerate(texts + texts[40:]))
    found = {(r.leaf, tuple(r.pieces)) for r in d.templates(d.parsed_lines(documents(spark, rows), d.Rule()), d.Rule(), len(rows)).collect()}
    ids = {}
    for i, t in rows:
        _, leaf, pieces, _ = d.line_keys(t.encode())
        ids.setdefault((leaf, tuple(pieces)), set()).add(i)
    assert found >= {k for k, v in ids.items() if len(v) > 1} != set()
    out = {r.doc_id: r.text for r in d.drop_recurring_lines(documents(spark, rows)).collect()}
    assert all(sum(out[i] == t for i, x in rows if x == t) <= 1 for t in set(texts))


def test_lines_of_few_tokens(spark):
    """A passage without spaces goes from two documents on; a word or two only where a share of all documents has them."""
    passage = "".join(chr(0x4E00 + (i * 37) % 500) for i in range(120))
    rows = [(i, f"{prose(i)}\nRead  more\n{'By chance' if i < 6 else prose(900 + i, 2)}\n{passage if i in (20, 30, 40) else i}") for i in range(1000)]
    out = {r.doc_id: r for r in d.drop_recurring_lines(documents(spark, rows)).collect()}
    assert [i for i in out if passage in out[i].text] == [20] and [i for i in out if "Read  more" in out[i].text] == [0]
    assert all("By chance" in out[i].text for i in range(6))
    assert all(out[i].n_lines_dropped == (i > 0) + (i in (30, 40)) for i in out)
