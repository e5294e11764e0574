import random
import re

from linetally.llm.decontaminate import LEAST_SCORE, LEAST_SHARE, MASKS, MISMATCH, SPAN, leaks, without_leaks

RNG = random.Random(6)
WORDS = [f"w{i}" for i in range(500)]


def some(n):
    return [RNG.choice(WORDS) for _ in range(n)]


def words_of(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def brute_force(rows, items):
    """All diagonals on which a whole mask agrees, verified."""
    out = set()
    for i, text in rows:
        d = words_of(text)
        for k, item in items:
            w = words_of(item)
            if len(w) < SPAN:
                continue
            best = 0
            for diagonal in range(-len(w), len(d)):
                equal = [0 <= diagonal + j < len(d) and d[diagonal + j] == w[j] for j in range(len(w))]
                looks = lambda m, j, e=equal: all(e[j + o] for o, bit in enumerate(m) if bit == "1")
                if any(looks(m, j) for m in MASKS for j in range(len(w) - len(m) + 1) if 0 <= diagonal + j and diagonal + j + len(m) <= len(d) + 5):
                    run = 0
                    for e in equal:
                        run = max(0, run) + (1 if e else -MISMATCH)
                        best = max(best, run)
            if best and best >= min(LEAST_SCORE, -(-LEAST_SHARE * len(w) // 1)):
                out.add((i, k, best))
    return out


def corpus():
    items = [(k, " ".join(some(n))) for k, n in enumerate([14, 20, 30, 59, 12])] + [(50, " ".join(some(11))), (51, None), (None, " ".join(some(15)))]
    rows = []
    for k, item in items:
        w = words_of(item)
        for wrong in (0, 1, 2, 6):
            x = list(w)
            for at in range(3, len(x), max(2, len(x) // wrong) if wrong else 999):
                x[at] = "other"
            rows.append((len(rows) + 100, " ".join([*some(20), *x, *some(9)])))
            rows.append((len(rows) + 100, ", ".join(x).upper()))
        rows.append((len(rows) + 100, " ".join([*some(30), *w[: len(w) // 2], *some(5)])))
    return rows, items


def test_same_as_brute_force(spark, frame, edge):
    rows, items = corpus()
    rows += edge + [(None, rows[0][1]), (900, rows[0][1]), (901, "same " * 300)]
    items.append((77, "same " * 20))
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = frame(rows)
    got = {(r["doc_id"], r["item_id"], r["score"]) for r in leaks(docs, bench).collect()}
    want = brute_force(rows, items)
    assert got == want and len(want) > 20
    kept = without_leaks(docs, bench)
    assert kept.columns == docs.columns
    clean = [(i, t) for i, t in rows if not brute_force([(i, t)], items)]
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(clean, key=str)


def test_sides_too_large_to_broadcast(spark, frame, monkeypatch):
    from linetally.llm import decontaminate

    rows, items = corpus()
    bench = spark.createDataFrame(items, "item_id long, text string")
    shuffled = decontaminate.with_overlaps(frame(rows), bench, "overlaps", most_seeds=0, most_hits=0)
    a = {(r["doc_id"], len(r["overlaps"] or [])) for r in shuffled.collect()}
    b = {(r["doc_id"], len(r["overlaps"] or [])) for r in decontaminate.with_overlaps(frame(rows), bench, "overlaps").collect()}
    assert a == b


def test_no_python(frame, spark):
    bench = spark.createDataFrame([(1, "text " * 20)], "item_id long, text string")
    plan = leaks(frame([(1, "x")]), bench)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_empty(spark, frame):
    none = spark.createDataFrame([], "item_id long, text string")
    assert leaks(frame([]), none).count() == 0 and without_leaks(frame([(1, "x")]), none).count() == 1


def test_short_items_are_found_whole(spark, frame, tmp_path):
    import corpus_pipeline
    from linetally.llm.queries import QUERIES

    items = [(n, " ".join(some(n))) for n in range(1, 12)] + [(20, ""), (21, None), (30, " ".join(some(30)))]
    rows = []
    for k, item in items:
        w = words_of(item)
        rows += [(len(rows), " ".join(["before", *w, "after"])), (len(rows) + 1, " ".join(w).upper()), (len(rows) + 2, " ".join(["x", *w[:-1]]))]
    rows += [(200 + i, " ".join(some(300))) for i in range(5)]
    held = lambda w, d: next((i for i in range(len(d) - len(w) + 1) if d[i : i + len(w)] == w), None) if w else None
    want = {(i, k, held(words_of(t), words_of(d))) for k, t in items[:11] for i, d in rows if held(words_of(t), words_of(d)) is not None}
    frame(rows).select("doc_id", "text").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = QUERIES["op1_spaced_seed_leaks"](spark, str(tmp_path)).collect()
    assert {(r["doc_id"], r["item_id"], r["first_word"]) for r in got if r["item_id"] < 20} == want and len(want) > 22
    assert all(r["score"] == r["n_words"] == r["n_equal"] == r["item_words"] == r["item_id"] for r in got if r["item_id"] < 20)
    kept = corpus_pipeline.without_leaks(spark, spark.read.parquet(str(tmp_path / "documents.parquet")), str(tmp_path))
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _ in rows} - {r["doc_id"] for r in got}


def test_scripts_without_blanks(spark, frame):
    item = "春眠不覚暁処処聞啼鳥夜来風雨声花落知多少"
    rows = [(1, f"序文です。{item}と続く"), (2, item[:9] + "一" + item[10:]), (3, "春眠"), (4, "english words only"), (5, "mixed 春 " + item[:8])]
    got = leaks(frame(rows), spark.createDataFrame([(1, item), (2, "春眠")], "item_id long, text string"), short_items=True).collect()
    assert {(r["doc_id"], r["item_id"], r["first_word"], r["n_equal"]) for r in got} == {
        (1, 1, 4, 20), (2, 1, 0, 19), (1, 2, 4, 2), (2, 2, 0, 2), (3, 2, 0, 2), (5, 2, 2, 2),
    }
