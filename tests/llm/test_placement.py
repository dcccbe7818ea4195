"""The placement of the two packings against naive forms of them."""

import numpy as np
import pytest

from claimsift.llm.packing import OpenSequences, RoomTree, best_fit_decreasing, cut


def naive_bounded(sizes, length, most):
    """Offsets, sequences opened and the sequences that were closed before the end, by plain search."""
    rooms, offsets, opened, closed = {}, [], 0, []
    for size in sizes:
        fits = [(room, -number) for number, room in rooms.items() if room >= size]
        if fits:
            room, number = min(fits)
            number = -number
        else:
            room, number = length, opened
            opened += 1
        offsets.append(length - room)
        rooms[number] = room - size
        if not rooms[number]:
            del rooms[number]
        if len(rooms) > most:
            fullest = min(rooms.values())
            number = max(n for n, room in rooms.items() if room == fullest)
            closed.append(fullest)
            del rooms[number]
    return offsets, opened, closed


@pytest.mark.parametrize("length, most", [(100, 5), (64, 1), (300, 40), (10, 1000)])
def test_bounded_best_fit_is_the_naive_one(length, most):
    sizes = np.random.RandomState(length).randint(1, length + 1, 600).tolist() + [length, 1, 1]
    bins = OpenSequences(length, most, 0)
    places = [bins.place(size) for size in sizes]
    offsets, opened, closed = naive_bounded(sizes, length, most)
    assert [offset for _, offset in places] == offsets
    assert len({number for number, _ in places}) == bins.next_id == opened
    assert bins.open <= most and (most >= 40 or closed)


def test_the_fullest_open_sequence_closes_first():
    bins = OpenSequences(100, 2, 0)
    first, second, third = (bins.place(size)[0] for size in (60, 70, 80))
    assert bins.place(20)[0] not in (third,)  # the one with 20 left was the fullest of three and is closed
    assert {first, second, third} == {0, 1, 2}


def naive_decreasing(sizes, length):
    rooms, offsets = [], {}
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fits = [(room, n) for n, room in enumerate(rooms) if room >= sizes[i]]
        room, n = min(fits) if fits else (length, len(rooms))
        if not fits:
            rooms.append(length)
        offsets[i] = length - room
        rooms[n] -= sizes[i]
    return [offsets[i] for i in range(len(sizes))], len(rooms)


@pytest.mark.parametrize("length", [7, 50, 2048])
def test_decreasing_best_fit_is_the_naive_one(length):
    sizes = np.random.RandomState(length).randint(1, length + 1, 400)
    sequence, offset = best_fit_decreasing(sizes, length)
    offsets, opened = naive_decreasing(sizes.tolist(), length)
    assert offset.tolist() == offsets and len(set(sequence.tolist())) == opened
    filled = np.bincount(sequence, sizes)
    assert filled.max() <= length and opened <= 11 / 9 * np.ceil(sizes.sum() / length) + 1


def test_room_tree_finds_the_least_room():
    tree, rooms, rng = RoomTree(63), [], np.random.RandomState(1)
    for step in range(500):
        if rooms and rng.rand() < 0.4:
            room = rooms.pop(rng.randint(len(rooms)))
            tree.take(room)
        else:
            rooms.append(int(rng.randint(1, 64)))
            tree.add(rooms[-1], step)
        size = int(rng.randint(0, 64))
        assert tree.least(size) == min((r for r in rooms if r >= size), default=None)


def test_cutting_is_lossless():
    counts = np.array([0, 1, 9, 10, 11, 20, 21, 35])
    doc, number, start, size = cut(counts, 10)
    assert np.bincount(doc, size).tolist() == counts.tolist() and size.max() == 10
    for i, n in enumerate(counts.tolist()):
        mine = doc == i
        assert number[mine].tolist() == list(range(max(1, -(-n // 10))))
        assert start[mine].tolist() == np.concatenate([[0], np.cumsum(size[mine])[:-1]]).tolist()
        assert (size[mine][1:] == 10).all()
