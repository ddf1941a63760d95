"""Random histories of a keyed table and their outcome, replayed row by row in a dict."""
from __future__ import annotations

import random

import messages as m

COLUMNS = [("id", 20, True), ("n", 23, False), ("body", 25, False)]


def history(seed: int, steps: int, keys: int = 6, relid: int = 7):
    """Snapshot, messages, and the table after all transactions but the last, open one.

    Long values are left out of updates when they do not change, also when the row changes its key.
    """
    rng = random.Random(seed)
    table = {i: (i, f"s{i}") for i in range(0, keys, 2)}
    snapshot = [(k, *v) for k, v in table.items()]
    texts = [m.begin(), m.relation(relid, "t", COLUMNS)]
    committed = dict(table)
    for step in range(steps):
        if rng.random() < 0.1:
            texts += [m.commit(), m.begin()]
            committed = dict(table)
            if rng.random() < 0.3:
                texts.append(m.relation(relid, "t", COLUMNS))
        free = [k for k in range(keys) if k not in table]
        what = rng.random()
        if what < 0.25 and free:
            k = rng.choice(free)
            table[k] = (step, rng.choice([None, "NULL", f"v{step}"]))
            texts.append(m.insert(relid, [k, *table[k]]))
        elif what < 0.4 and table:
            k = rng.choice(sorted(table))
            del table[k]
            texts.append(m.delete(relid, [k, None, None]))
        elif table:
            k = rng.choice(sorted(table))
            body, sent = table[k][1], m.U
            if rng.random() < 0.4:
                body = sent = rng.choice([None, f"w{step}"])
            if what > 0.65 and free:
                to = rng.choice(free)
                del table[k]
                table[to] = (step, body)
                texts.append(m.update(relid, [to, step, sent], [k, None, None]))
            else:
                table[k] = (step, body)
                texts.append(m.update(relid, [k, step, sent]))
    return snapshot, texts, sorted((k, *v) for k, v in committed.items())
