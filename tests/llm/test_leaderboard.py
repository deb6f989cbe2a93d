import datetime
import random
from zlib import crc32

from eventpulse.llm import leaderboard as L

LINES = "sale_id long, line_no int, item_id long, vendor_id long, quantity int, amount double, discount double, flag string, shipped_at timestamp_ntz, day string, batch string, nation_id string"
DAY0 = datetime.datetime(2024, 1, 1)


def floor(x):
    return int(x // 1)


def brute(lines, price, nation):
    """The contract, day by day over plain dictionaries."""
    cut = {}
    for sale, no, item, vendor, quantity, amount, flag, at in lines:
        h = crc32(",".join("" if x is None else str(x) for x in (sale, item, vendor, no)).encode())
        s = (at - datetime.datetime(1970, 1, 1)).days if at else 19723 + h % 150
        a = s + h % 7 + (20 if h % 5 == 0 else 0)
        cut.setdefault(max(1, min(8, 1 + floor((a - 19723) * 8 / 180))), []).append((s, a, item, vendor, quantity, amount, flag))
    latest, revenue, shown, out = None, {}, {}, []
    for batch in sorted(cut):
        by_day = {}
        for s, a, item, vendor, quantity, amount, flag in cut[batch]:
            if (latest is None or s + 15 >= latest) and nation.get(vendor) is not None and item in price:
                by_day.setdefault(a, []).append((nation[vendor], item, quantity, amount, flag))
        for a in sorted(by_day):
            for n, item, quantity, amount, flag in by_day[a]:
                cents = floor(100 * amount + 0.5) if amount is not None else quantity * floor(100 * price[item] + 0.5) if quantity is not None and price[item] is not None else 0
                own = revenue.setdefault(n, {})
                own[item] = own.get(item, 0) + (-cents if flag == "swapped" else cents)
            for n, own in revenue.items():
                best = sorted(((-c, i) for i, c in own.items() if c > 0))[:10]
                now, old = {i: k + 1 for k, (_, i) in enumerate(best)}, shown.get(n, {})
                for i in now.keys() | old.keys():
                    if now.get(i) != old.get(i):
                        change = "enter" if i not in old else "exit" if i not in now else "move"
                        out.append((n, a, i, batch, change, old.get(i), now.get(i), own[i]))
                shown[n] = now
        latest = max([s for s, *_ in cut[batch]] + ([latest] if latest is not None else []))
    return sorted(out)


def feed(spark, lines, price, nation, **more):
    frame = spark.createDataFrame([(sale, no, item, vendor, q, amount, 0.1, flag, at, "x", "y", "z") for sale, no, item, vendor, q, amount, flag, at in lines], LINES)
    items = spark.createDataFrame([(i, p, "n") for i, p in price.items()], "item_id long, price double, flag string")
    vendors = spark.createDataFrame([(v, n) for v, n in nation.items()], "vendor_id long, nation_id int")
    got = L.change_feed(frame, items, vendors, **more)
    assert got.columns == ["nation_id", "arrival_day", "item_id", "batch", "change", "old_rank", "new_rank", "revenue"]
    return sorted(tuple(r) for r in got.collect())


def shop(seed, n, items=30):
    rng = random.Random(seed)
    price = {i: rng.choice([None, 1.005, 3.0, 7.77]) for i in range(items)}
    nation = {v: rng.choice([None, 1, 1, 2]) for v in range(6)}
    lines = []
    for _ in range(n):
        at = None if rng.random() < 0.05 else DAY0 + datetime.timedelta(days=rng.randrange(150), hours=rng.randrange(24))
        item = rng.choice([3, rng.randrange(items + 3), None]) if rng.random() < 0.5 else rng.randrange(items)
        lines.append((rng.choice([None, rng.randrange(900)]), rng.choice([None, 1, 2]), item, rng.choice([None, rng.randrange(8)]), rng.choice([None, 1, 5]), rng.choice([None, 2.5, 19.999, 100.0]), rng.choice(["kept", "swapped", None]), at))
    return lines + lines[:20], price, nation  # repeats count again


def test_as_brute_force_over_several_shares(spark):
    lines, price, nation = shop(2, 900)
    want = brute(lines, price, nation)
    assert {r[4] for r in want} == {"enter", "exit", "move"}
    assert feed(spark, lines, price, nation, items_a_state=7) == want


def test_ties_few_items_and_gaps_of_batches(spark):
    at = lambda d: DAY0 + datetime.timedelta(days=d)
    lines = [(k, 1, i, 1, 1, 5.0, "kept", at(d)) for k, (i, d) in enumerate([(i, d) for d in (0, 100) for i in range(12)])] + [(99, 1, 0, 1, 1, 50.0, "swapped", at(120)), (100, 1, 1, 1, 1, 5.0, "kept", at(1))]
    price, nation = {i: 1.0 for i in range(12)}, {1: 4}
    assert feed(spark, lines, price, nation) == brute(lines, price, nation)


def test_no_lines_and_no_known_nation(spark):
    assert feed(spark, [], {1: 1.0}, {1: 1}) == []
    assert feed(spark, [(1, 1, 1, 9, 1, 1.0, "kept", DAY0)], {1: 1.0}, {1: 1}) == []


def test_stale_and_repeated_entries_are_skipped():
    board = L.Board({})
    for item, cents in [(1, 10), (2, 30), (1, 25), (2, -25), (1, -25), (1, 25), (3, 7)]:
        board.add(item, cents)
    assert list(board.best(2).items()) == [(1, 35), (3, 7)]  # 35 was reached twice: one of its entries goes
    assert list(board.best(10).items()) == [(1, 35), (3, 7), (2, 5)]
    for _ in range(500):
        board.add(3, 1)
    assert len(board.heap) <= 2 * len(board.revenue) + 65 and next(iter(board.best(1).items())) == (3, 507)


def test_numbers_are_packed_without_loss():
    import numpy as np

    for x in ([], [5], [-3, 9, 2**62, -(2**62), 0]):
        assert L._unpack(L._pack(np.array(x, np.int64))) == x
