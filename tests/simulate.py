"""The queue's rules row by row, in plain Python."""


def send_key(row):
    return tuple((v is not None, v if v is not None else 0) for v in (row[4], row[2], row[0]))


def batch(rows, count_limit, byte_limit):
    """Ids of the next batch."""
    taken, size = [], 0
    for row in sorted((r for r in rows if r[5] is None), key=send_key):
        if count_limit and len(taken) >= count_limit:
            break
        taken.append(row[0])
        if byte_limit:
            size += row[1] or 0
            if size >= byte_limit:
                break
    return taken


def trim_rows(rows, limit):
    return [r[0] for r in sorted(rows, key=send_key)][:limit]


def trim_bytes(rows, limit):
    if sum(r[1] or 0 for r in rows) <= limit:
        return [r[0] for r in rows]
    kept, size = [], 0
    for row in sorted(rows, key=send_key):
        kept.append(row[0])
        size += row[1] or 0
        if size >= limit:
            break
    return kept


def drain(rows, count_limit, byte_limit):
    """Batch number of every unassigned packet."""
    left, number, found = list(rows), 0, {}
    while True:
        ids = batch(left, count_limit, byte_limit)
        if not ids:
            return found
        number += 1
        found.update({i: number for i in ids})
        gone = set(ids)
        left = [r for r in left if r[0] not in gone]
