"""The semantics in plain Python over small lists of events, by direct counting.

An event is (user, item, category, behavior, day). Nothing here groups, windows or joins:
every feature is a sum over the event list. A null item or category equals nothing.
"""

ENGAGED = {"buy", "cart", "fav"}


def popular(events, top):
    counts = {}
    for _, item, cat, _, _ in events:
        counts[item, cat] = counts.get((item, cat), 0) + 1
    return sorted(counts, key=lambda k: (-counts[k], *nulls_last(k)))[:top]


def nulls_last(key):
    return [(value is None, value or 0) for value in key]


def features(events, user, item, cat, day, eps):
    def n(test):
        return sum(1 for e in events if test(e))

    if item is None:
        item = object()
    if cat is None:
        cat = object()
    same_day_ui = n(lambda e: e[0] == user and e[1] == item and e[4] == day)
    same_day_uc = n(lambda e: e[0] == user and e[2] == cat and e[4] == day)
    same_day_i = n(lambda e: e[1] == item and e[4] == day)
    same_day_c = n(lambda e: e[2] == cat and e[4] == day)
    ui = n(lambda e: e[0] == user and e[1] == item and e[4] < day) if same_day_ui else 0
    uc = n(lambda e: e[0] == user and e[2] == cat and e[4] < day) if same_day_uc else 0
    ue = (
        n(lambda e: e[0] == user and e[2] == cat and e[4] < day and e[3] in ENGAGED)
        if same_day_uc else 0
    )
    ip = n(lambda e: e[1] == item and e[4] < day) if same_day_i else 0
    cp = n(lambda e: e[2] == cat and e[4] < day) if same_day_c else 0
    te = 0.5
    if same_day_c:
        past = [e for e in events if e[2] == cat and e[4] < day]
        te = (sum(e[3] in ENGAGED for e in past) + 1.0) / (len({e[4] for e in past}) + 2.0)
    lags = [0, 0]
    if same_day_uc:
        active = sorted({e[4] for e in events if e[0] == user and e[2] == cat and e[4] < day})
        for i, d in enumerate(reversed(active[-2:])):
            lags[i] = n(lambda e: e[0] == user and e[2] == cat and e[4] == d)
    return (ui, uc, ue, (ue + eps) / (uc + eps), ip, cp, te, lags[0], lags[1])


def matrix(events, cfg):
    """Rows (user, item, category, day, label, split, *features) of all splits."""
    s = cfg.splits
    split_of = {d: name for name, days in s.as_dict().items() for d in days}
    positives = {
        (u, i, c, d) for u, i, c, b, d in events if b in ENGAGED and d in s.labelled
    }
    rows = [(*k, 1) for k in positives]
    touched = {(u, i, d) for u, i, _, _, d in events if i is not None}
    menu = sorted(popular(events, cfg.top_popular), key=nulls_last)
    for user, day in {(u, d) for u, _, _, d in positives}:
        unseen = [(i, c) for i, c in menu if (user, i, day) not in touched]
        rows += [(user, i, c, day, 0) for i, c in unseen[: cfg.neg_ratio]]
    rows += [(*k, None) for k in {(u, i, c, d) for u, i, c, _, d in events if d in s.infer}]
    return [
        (u, i, c, d, label, split_of[d], *features(events, u, i, c, d, cfg.epsilon))
        for u, i, c, d, label in rows
    ]
