"""Byte-passage dedup by interval expansion on a Burrows-Wheeler transform.

Equal strings of ``least`` bytes meet because each is dealt out by the smallest
hash of the short strings inside it: consecutive strings with one such key form
a segment, and only segments whose key two documents hold are sent. A task
sorts its segments' suffixes, takes the transform, and extends the intervals of
strings with several occurrences backwards, all intervals of one length at a
time, until the length is reached. Longer common prefixes are never looked at.
"""

from struct import pack, unpack_from

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Window
from pyspark.sql import functions as F

from catalogflow.llm.common import ROW, arrow, exact_copies, keyed, mixed, packed_runs, plain_id, slices, starts_of

GRAM, HEAT, PIECE, TASK_BYTES, PART_BYTES = 16, 5000, 2000, 250_000, 250_000
KEY = np.uint64(2**48 - 1)  # the bits of a key: fewer bytes are shuffled, and keys that meet by chance only cost work
FOUND = "key long, _id long, _row long, docs int, pos binary"
FOUND_ARROW = pa.schema([("key", pa.int64()), ("_id", pa.int64()), ("_row", pa.int64()), ("docs", pa.int32()), ("pos", pa.binary())])
# what differs from row to row side by side compresses better
SENT = "key long, start int, _row long, _id long, known boolean, seg binary"
SENT_ARROW = pa.schema([("key", pa.int64()), ("start", pa.int32()), ("_row", pa.int64()), ("_id", pa.int64()),
                        ("known", pa.bool_()), ("seg", pa.binary())])
SPANS = "_id long, _row long, spans binary"
# segments travel in packs, dealt out by their keys: numbers and texts side by side, compressed together
DEAL, PACK = 2048, "deal int, pack binary"
PACKED = (("key", np.int64), ("start", np.int32), ("_row", np.int64), ("_id", np.int64), ("known", np.bool_), ("size", np.int32))


def window_keys(buffer, least, gram):
    """For each place: the smallest hash of the ``gram``-byte strings in the ``least`` bytes from there on."""
    n, w = len(buffer) - least + 1, least - gram + 1
    loads = lambda k: np.ndarray((n + w - 1,), "<u8", buffer, k, (1,))
    step = 8 if gram >= 16 else gram - 8
    h = loads(0) * np.uint64(0x9E3779B97F4A7C15)
    h = mixed(h ^ loads(step)) * np.uint64(0xD1342543DE82EF95)
    h = mixed(h ^ loads(gram - 8))
    size = -(-len(h) // w) * w
    padded = np.full(size, np.iinfo(np.uint64).max)
    padded[: len(h)] = h
    blocks = padded.reshape(-1, w)
    left = np.minimum.accumulate(blocks, 1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[w - 1 : w - 1 + n])


def _runs(texts, least, gram):
    """Maximal runs of windows with one key, over several texts: (text, first window, last window, key)."""
    at, parts = 0, []
    while at < len(texts):
        size, end = 0, at
        while end < len(texts) and (size == 0 or size + len(texts[end]) <= PART_BYTES):
            size += len(texts[end])
            end += 1
        if size >= least:
            lengths = np.array([len(t) for t in texts[at:end]])
            first = np.r_[0, np.cumsum(lengths)[:-1]]
            key = window_keys(b"".join(texts[at:end]), least, gram) & KEY
            doc = np.repeat(np.arange(len(lengths)), lengths)[: len(key)]
            place = np.arange(len(key)) - first[doc]
            ok = place <= lengths[doc] - least
            change = np.r_[True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1]) | ~ok[:-1]]
            s = np.flatnonzero(change & ok)
            stop = np.flatnonzero(np.r_[(change[1:] | ~ok[1:]), True] & ok)
            parts.append((doc[s] + at, place[s], place[stop], key[s]))
        at = end
    if not parts:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _sent(key):
    """The low 40 bits of a key, its random bytes next to those of the id: they compress better."""
    return (key << np.uint64(24)).view(np.int64)


def _short(key):
    """31 bits of a key, which tell the keys of one document apart well enough: another key marked too only costs work."""
    return (key & np.uint64(0x7FFFFFFF)).astype(np.int32)


def _anchors(least, gram):
    def run(batches):
        for batch in slices(batches, "_text"):
            ids, tags = batch.column("_id").to_numpy(), batch.column("_row").to_numpy()
            doc, _, _, key = _runs(batch.column("_text").to_pylist(), least, gram)
            yield from _combined(key, ids[doc], tags[doc])

    return run


def _combined(key, ids, tags):
    """Rows for the shuffle out of one batch's keys, as in ``sharing``: a key that documents of the batch share goes on once."""
    if not len(key):
        return
    order = np.argsort(key)
    s = starts_of([key[order]])
    size = np.diff(np.r_[s, len(key)])
    again = order[np.repeat(size > 1, size)]
    alone = np.ones(len(key), bool)
    alone[again] = False
    sent = [(key[alone], ids[alone], tags[alone], np.ones(int(alone.sum()), np.int32))]
    if len(again):
        again = again[np.lexsort((tags[again], ids[again], key[again]))]
        k, i, t = key[again], ids[again], tags[again]
        one = starts_of([k, i, t])
        k, i, t = k[one], i[one], t[one]
        s = starts_of([k])
        new = np.zeros(len(k), np.int32)
        new[starts_of([k, i])] = 1
        docs = np.add.reduceat(new, s)
        here = np.repeat(docs > 1, np.diff(np.r_[s, len(k)]))
        lead = s[docs > 1]
        sent += [(k[~here], i[~here], t[~here], np.ones(int((~here).sum()), np.int32)), (k[lead], i[lead], t[lead], docs[docs > 1])]
        if here.any():
            k, i, t = k[here], i[here], t[here]
            o = np.lexsort((k, t, i))
            k, i, t = k[o], i[o], t[o]
            s = starts_of([i, t])
            own = mixed(i[s].view(np.uint64) * np.uint64(31) + t[s].view(np.uint64))
            yield arrow(FOUND_ARROW, own.view(np.int64), i[s], t[s], np.zeros(len(s), np.int32), packed_runs(_short(k), s))
    # rows of one document stay side by side: they compress better
    k, i, t, docs = (np.concatenate(x) for x in zip(*sent))
    yield arrow(FOUND_ARROW, _sent(k), i, t, docs, pa.nulls(len(k), pa.binary()))


def _shared(found):
    """One row per document: its keys that other documents hold, shortened."""
    over = Window.partitionBy("key")
    found = found.withColumns({"_lo": F.min("_id").over(over), "_hi": F.max("_id").over(over), "_docs": F.sum("docs").over(over)})
    # rows with more than one document only tell the other batches
    kept = found.filter("pos is not null or (docs = 1 and (_lo < _hi or _docs > 1))")
    short = F.shiftright("key", 24).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")
    return kept.groupBy(*ROW).agg(F.collect_list("pos").alias("_pos"), F.collect_list(F.when(F.col("pos").isNull(), short)).alias("_short"))


def _shrunk(batches):
    """Texts compressed one by one for the shuffle."""
    codec = pa.Codec("zstd", 1)
    for batch in slices(batches, "_text"):
        texts = batch.column("_text").to_pylist()
        small = [pack("<i", len(t)) + codec.compress(t, asbytes=True) if t else b"" for t in texts]
        yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_row"), pa.array(small, pa.binary())], names=[*ROW, "_small"])


def _texts(small):
    codec = pa.Codec("zstd")
    return [codec.decompress(memoryview(t)[4:], unpack_from("<i", t)[0], asbytes=True) if t else b"" for t in small.to_pylist()]


def _sizes(batch):
    """Bytes of each text."""
    return np.array([unpack_from("<i", t)[0] if t else 0 for t in batch.column("_small").to_pylist()], np.int64)


def _segments(least, gram):
    def run(batches):
        for batch in slices(batches, _sizes):
            ids, tags = batch.column("_id").to_pylist(), batch.column("_row").to_pylist()
            texts = _texts(batch.column("_small"))
            doc, first, last, key = _runs(texts, least, gram)
            shorts = batch.column("_short")
            packed = [b"".join(p or ()) for p in batch.column("_pos").to_pylist()]
            sizes = pc.fill_null(pc.list_value_length(shorts), 0).to_numpy(zero_copy_only=False)
            owner = np.r_[np.repeat(np.arange(len(texts)), sizes), np.repeat(np.arange(len(texts)), [len(p) // 4 for p in packed])]
            wanted = np.r_[shorts.flatten().to_numpy(zero_copy_only=False), np.frombuffer(b"".join(packed), np.int32)].astype(np.int64)
            use = np.isin(doc << 31 | _short(key), owner << 31 | wanted)
            out, chosen = [], np.flatnonzero(use)
            for i, p, z, k in zip(*(x[chosen].tolist() for x in (doc, first, last, key))):
                text, row, tag = texts[i], ids[i], tags[i]
                while p <= z:
                    end = min(p + PIECE, z + 1)
                    out.append((k, row, tag, p, text[p : end - 1 + least]))
                    p = end
            if out:
                yield _packed(*_dealt(out))

    return run


def _packed(key, start, tags, ids, known, segments):
    """Packs of one batch's segments, one for each value that keys are dealt out by."""
    codec = pa.Codec("zstd", 1)
    deal = key % DEAL
    order = np.argsort(deal, kind="stable")
    s = starts_of([deal[order]])
    sizes = np.array([len(x) for x in segments], np.int32)
    packs = []
    for a, z in zip(s.tolist(), [*s[1:].tolist(), len(order)]):
        o = order[a:z]
        columns = (key[o] // DEAL, start[o], tags[o], np.diff(ids[o], prepend=0), known[o], sizes[o])
        # byte by byte, so that the zeros of small numbers meet
        raw = b"".join([np.ascontiguousarray(c, t).view(np.uint8).reshape(len(o), -1).T.tobytes() for c, (_, t) in zip(columns, PACKED)]
                       + [segments[i] for i in o.tolist()])
        packs.append(pack("<ii", len(raw), len(o)) + codec.compress(raw, asbytes=True))
    return pa.RecordBatch.from_arrays([pa.array(deal[order][s].astype(np.int32)), pa.array(packs, pa.binary())], names=["deal", "pack"])


def _unpacked(batches):
    """Segments out of their packs, some packs at a time."""
    codec = pa.Codec("zstd")
    sizes = lambda batch: np.array([unpack_from("<i", p)[0] for p in batch.column("pack").to_pylist()], np.int64)
    for batch in slices(batches, sizes, 8 * PART_BYTES):
        parts, texts = [], []
        for deal, packed in zip(batch.column("deal").to_pylist(), batch.column("pack").to_pylist()):
            total, n = unpack_from("<ii", packed)
            raw, at, part = codec.decompress(memoryview(packed)[8:], total, asbytes=True), 0, {}
            for name, t in PACKED:
                width = np.dtype(t).itemsize
                planes = np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n)
                part[name], at = np.ascontiguousarray(planes.T).view(t).ravel(), at + n * width
            part["key"] = part["key"] * DEAL + deal
            part["_id"] = np.cumsum(part["_id"])
            parts.append(part)
            texts.append(memoryview(raw)[at:])
        whole = {name: np.concatenate([p[name] for p in parts]) for name, _ in PACKED}
        ends = np.r_[0, np.cumsum(whole.pop("size"), dtype=np.int64)].astype(np.int32)
        segments = pa.BinaryArray.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(b"".join(texts))])
        yield pa.RecordBatch.from_arrays([*(pa.array(whole[f.name], f.type) for f in list(SENT_ARROW)[:-1]), segments], schema=SENT_ARROW)


def _split(batches, heat):
    """Rows in the order of their keys, those of one key all crowded (more than ``heat``) or none: (crowded, batch)."""
    tail, size, last = [], 0, None  # the rows of a key that may go on
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column("key").to_numpy()
        s = np.r_[starts_of([key]), len(key)].tolist()
        at = 0
        if key[0] == last:
            at = s.pop(0) or s[0]
            tail.append(batch.slice(0, at))
            size += at
            if size > heat:
                yield from ((True, t) for t in tail)
                tail = []
            if at == len(key):
                continue
        yield from ((False, t) for t in tail)
        for a, z in zip(s[:-2], s[1:-1]):
            if z - a > heat:
                if a > at:
                    yield False, batch.slice(at, a - at)
                yield True, batch.slice(a, z - a)
                at = z
        if s[-2] > at:
            yield False, batch.slice(at, s[-2] - at)
        tail, size, last = [batch.slice(s[-2])], len(key) - s[-2], key[-1]
        if size > heat:
            yield True, tail.pop()
    yield from ((False, t) for t in tail)


def _windows(least, heat):
    """Each window of the segments of a crowded key, dealt out by its own hash."""

    def run(batches):
        rows = (batch.filter(pc.invert(batch.column("known"))) for batch in batches)
        for batch in slices((b for crowded, b in _split(rows, heat) if crowded), "seg", 4 * PART_BYTES // least):
            rows = zip(*(batch.column(c).to_pylist() for c in ("_id", "_row", "start", "seg")))
            cut = ((i, tag, start + p, seg[p : p + least]) for i, tag, start, seg in rows for p in range(len(seg) - least + 1))
            yield arrow(SENT_ARROW, *_dealt([(xxhash.xxh3_64_intdigest(w), i, tag, at, w) for i, tag, at, w in cut]))

    return run


def _dealt(found):
    """Columns to send out of one batch's (key, id, row, start, segment)."""
    best = {}
    for k, i, _, _, seg in found:
        if best.get((k, seg), i) >= i:
            best[k, seg] = i
    known = [i > best[k, seg] for k, i, _, _, seg in found]
    names, ids, tags, starts, segments = zip(*found)
    names = np.array(names, np.uint64)
    key = np.where(known, mixed(names ^ np.arange(len(names), dtype=np.uint64)) & KEY, names).view(np.int64)
    # of a segment that a smaller id of the batch holds, only the removed span goes on
    segments = [pack("<ii", p, p + len(seg)) if n else seg for p, seg, n in zip(starts, segments, known)]
    return key, np.array(starts, np.int32), np.array(tags, np.int64), np.array(ids, np.int64), np.array(known), segments


def _sorted_suffixes(sym, depth):
    """Order of all suffixes by their first ``depth`` symbols or more, and their ranks by the symbols of the round before."""
    n = len(sym)
    used = np.zeros(257, bool)
    used[sym] = True
    code = np.cumsum(used).astype(np.uint64)  # 0 stands after the end
    bits = int(code[-1]).bit_length()
    h = min(64 // bits, depth - 1)
    padded = np.concatenate([code[sym], np.zeros(h, np.uint64)])
    key = np.zeros(n, np.uint64)
    for k in range(h):
        key = (key << np.uint64(bits)) | padded[k : k + n]
    while True:
        order = np.argsort(key)  # what ties has more than ``depth`` symbols in common
        ranked = key[order]
        place = np.empty(n, np.uint64)
        place[1:] = np.cumsum(ranked[1:] != ranked[:-1])
        place[0] = 0
        rank = np.empty(n, np.uint64)
        rank[order] = place + np.uint64(1)
        if h >= depth:
            return order, half, half_depth
        half, half_depth = rank, h
        bits = int(place[-1] + np.uint64(1)).bit_length()
        steps = 2 if 2 * h >= depth or 3 * bits > 64 else 3
        key = rank.copy()
        for k in range(1, steps):
            key <<= np.uint64(bits)
            key[: max(n - k * h, 0)] |= rank[k * h :]
        h *= steps


def repeated(segments, least):
    """Intervals of the strings of ``least`` bytes that occur several times: (suffixes, low, high).

    segments: byte strings. Suffix numbers are places in the segments, each
    followed by one separator.
    """
    text = np.frombuffer(b"\0".join(segments) + b"\0", np.uint8).astype(np.uint16) + np.uint16(1)
    sizes = np.array([len(s) + 1 for s in segments])
    ends = np.cumsum(sizes) - 1
    text[ends] = 0
    order, half, depth = _sorted_suffixes(text, least)
    last = text[order - 1]  # the transform; place -1 is the last separator
    back = np.empty(len(text), np.int64)
    back[np.argsort(last, kind="stable")] = np.arange(len(text))
    changes = np.cumsum(np.r_[0, last[1:] != last[:-1]])
    rank = half[order]
    low = np.flatnonzero(np.r_[True, rank[1:] != rank[:-1]])
    high = np.r_[low[1:], len(text)]
    inside = order[low] + depth <= np.repeat(ends, sizes)[order[low]]  # no separator in the string
    low, high = low[inside], high[inside]
    for _ in range(least - depth):
        several = high - low > 1
        low, high = low[several], high[several]
        same = changes[high - 1] == changes[low]
        a, b = low[same], high[same]
        a, b = (x[last[a] > 0] for x in (a, b))
        nexts = [(back[a], back[b - 1] + 1)]
        a, size = low[~same], (high - low)[~same]
        if len(a):
            which = np.repeat(np.arange(len(a)), size)
            spot = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + a[which]
            spot, which = spot[last[spot] > 0], which[last[spot] > 0]
            group = which * 512 + last[spot]
            o = np.argsort(group, kind="stable")
            group, to = group[o], back[spot[o]]
            s = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.empty(0, np.int64)
            if len(s):
                nexts.append((to[s], to[np.r_[s[1:], len(to)] - 1] + 1))
        low, high = (np.concatenate(x) for x in zip(*nexts))
    several = high - low > 1
    return order, low[several], high[several]


def first_holders(segments, owners, least):
    """For each place of the segments, each followed by one separator, the smallest owner of the string there; without another holder, its own."""
    order, low, high = repeated(segments, least)
    holder = np.repeat(owners, [len(s) + 1 for s in segments])
    if len(low):
        count = high - low
        begin = np.cumsum(count) - count
        place = order[np.arange(count.sum()) + np.repeat(low - begin, count)]
        holder[place] = np.repeat(np.minimum.reduceat(holder[place], begin), count)
    return holder


def _spans(row, places, start, least):
    """Window starts, by row and place, as packed (from, to) byte places: the rows that have some, one packed string for each."""
    s = starts_of([row, places - np.arange(len(row))])
    row, places, last = row[s], places[s], places[np.r_[s[1:], len(row)] - 1]
    pairs = np.stack([places + start[row], last + start[row] + least], 1).astype(np.int32)
    t = starts_of([row])
    ends = np.r_[t, len(row)].astype(np.int32) * 8
    return row[t], pa.BinaryArray.from_buffers(pa.binary(), len(t), [None, pa.py_buffer(ends), pa.py_buffer(pairs.tobytes())])


def _judged(least, heat=np.inf):
    """Segments in the order of their keys to removed spans; whole keys, as many as caches hold, none that is crowded."""

    def judge(held):
        key, ids, tags, start = (np.concatenate([b.column(c).to_numpy() for b in held]) for c in ("key", "_id", "_row", "start"))
        number = {}
        kind = np.array([number.setdefault(s, len(number)) for b in held for s in b.column("seg").to_pylist()])
        segments = list(number)
        width = np.array([len(s) for s in segments]) - least + 1
        best = np.full(len(segments), np.iinfo(np.int64).max)
        np.minimum.at(best, kind, ids)
        of = np.empty(len(segments), np.int64)
        of[kind] = key
        # equal strings have one key: the only segment of a key shares strings with none but its copies
        _, which, kinds = np.unique(of, return_inverse=True, return_counts=True)
        met = np.flatnonzero(kinds[which] > 1)
        # most segments go or stay as a whole: for these the bounds of their holders decide
        low, high, begin = best.copy(), best.copy(), np.zeros(len(segments), np.int64)
        if len(met):
            holder = first_holders([segments[n] for n in met.tolist()], best[met], least)
            begin[met] = np.cumsum(width[met] + least) - width[met] - least
            edges = np.stack([begin[met], begin[met] + width[met]], 1).ravel()
            low[met], high[met] = np.minimum.reduceat(holder, edges)[::2], np.maximum.reduceat(holder, edges)[::2]
        gone = high[kind] < ids
        part = np.flatnonzero(~gone & (low[kind] < ids))
        gone = np.flatnonzero(gone)
        whole = np.stack([start[gone], start[gone] + width[kind[gone]] + least - 1], 1).astype(np.int32)
        ends = np.arange(len(gone) + 1, dtype=np.int32) * 8
        found = [(gone, pa.BinaryArray.from_buffers(pa.binary(), len(gone), [None, pa.py_buffer(ends), pa.py_buffer(whole.tobytes())]))]
        if len(part):
            count = width[kind[part]]
            row = np.repeat(part, count)
            place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            held_before = holder[place + begin[kind[row]]] < ids[row]
            found.append(_spans(row[held_before], place[held_before], start, least))
        for row, spans in found:
            if len(row):
                yield pa.RecordBatch.from_arrays([pa.array(ids[row]), pa.array(tags[row]), spans], names=["_id", "_row", "spans"])

    def run(batches):
        sure, held, size, last = [], [], 0, None

        def open_rows():
            for batch in batches:
                known = batch.column("known")
                sure.append(batch.filter(known))
                yield batch.filter(pc.invert(known))

        for crowded, batch in _split(open_rows(), heat):
            if not crowded:
                key, at = batch.column("key").to_numpy(), 0
                before = np.r_[0, np.cumsum(pc.binary_length(batch.column("seg")).to_numpy())]
                new = np.flatnonzero(np.r_[last is not None and key[0] != last, key[1:] != key[:-1]])
                full = before[new]
                while (k := np.searchsorted(full, before[at] + TASK_BYTES - size)) < len(new):
                    held.append(batch.slice(at, new[k] - at))
                    yield from judge(held)
                    held, size, at = [], 0, int(new[k])
                held.append(batch.slice(at))
                size, last = size + int(before[-1] - before[at]), key[-1]
            while sure:
                yield certain(sure.pop())
        while sure:
            yield certain(sure.pop())
        if held:
            yield from judge(held)

    def certain(batch):
        return pa.RecordBatch.from_arrays([batch.column(c) for c in ("_id", "_row", "seg")], names=["_id", "_row", "spans"])

    return run


def _kept(least):
    def run(batches):
        for batch in slices(batches, _sizes):
            out = []
            for text, spans, first in zip(_texts(batch.column("_small")), *(batch.column(c).to_pylist() for c in ("_spans", "first"))):
                n = len(text)
                if first is not None and n >= least:
                    out.append((n, n, 1, b""))
                elif spans:
                    edge = np.zeros(n + 1, np.int32)
                    pairs = np.frombuffer(b"".join(spans), np.int32).reshape(-1, 2)
                    np.add.at(edge, pairs[:, 0], 1)
                    np.add.at(edge, pairs[:, 1], -1)
                    gone = np.cumsum(edge[:n]) > 0
                    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    out.append((n, int(gone.sum()), runs, np.frombuffer(text, np.uint8)[~gone].tobytes()))
                else:
                    out.append((n, 0, 0, text))
            total, removed, runs, kept = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()),
                 pa.array(kept, pa.binary())], names=["_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return run


def dedup_bytes(docs, least=50, gram=GRAM, heat=HEAT, id_col="doc_id", text_col="text"):
    """Remove each byte covered by a string of ``least`` bytes that also starts in a smaller id.

    Returns one row per input row: doc_id, n_bytes, n_removed, n_spans (maximal
    removed runs) and kept (the other bytes, as binary: a cut can fall into a
    character). Strings are judged on the input and never cross documents. A
    null text is empty; texts under ``least`` bytes stay whole; rows that share
    an id remove nothing from each other; a null id counts as the largest.
    Keys of more than ``heat`` segments are dealt out again by whole strings, all
    of them, so that no task judges them alone; the result is the same. ``gram`` lies between 8 and ``least``.
    """
    rows = keyed(docs, id_col, text_col)
    copies = exact_copies(rows)
    shared = _shared(rows.mapInArrow(_anchors(least, gram), FOUND))
    # the filter drops nothing: with it both joins see one plan, and the texts are shuffled once
    small = rows.mapInArrow(_shrunk, "_id long, _row long, _small binary").filter("_id is not null and _row is not null")
    around = small.join(shared.hint("merge"), ROW).join(copies, ROW, "left_anti")
    packs = around.mapInArrow(_segments(least, gram), PACK).repartition("deal")
    dealt = packs.mapInArrow(_unpacked, SENT).sortWithinPartitions("key")
    crowded = dealt.mapInArrow(_windows(least, heat), SENT).repartition("key").sortWithinPartitions("key")
    spans = dealt.mapInArrow(_judged(least, heat), SPANS).unionByName(crowded.mapInArrow(_judged(least), SPANS))
    per_row = spans.groupBy(*ROW).agg(F.collect_list("spans").alias("_spans"))
    whole = small.join(per_row.hint("merge"), ROW, "left").join(copies, ROW, "left")
    out = whole.mapInArrow(_kept(least), "_id long, n_bytes long, n_removed long, n_spans long, kept binary")
    return out.select(plain_id("doc_id"), "n_bytes", "n_removed", "n_spans", "kept")
