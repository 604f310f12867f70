"""Shortest paths by the auction algorithm: node prices, path extension and contraction.

A path grows from the source. At its last node i the best arc is that with the least cost + price of its head. If the price
of i is below that, it rises to it and the path contracts by a node; else the path is extended along the best arc. Prices
never pass a node's distance to the sink, and are equal to it on the path when the sink is reached. Costs are whole numbers
of 0 or more, and every cycle costs more than 0. Nodes without a way to the sink must start with an infinite price: around a
cycle of such nodes prices would rise for ever.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

INFINITE = float("inf")

#: node -> its arcs (label, head, cost), in the order of their labels.
Arcs = Sequence[Sequence[tuple[str, int, int]]]


def auction(arcs: Arcs, source: int, sink: int, price: list[float]) -> None:
    """Raise prices until that of the source is its distance to the sink, infinite if there is no way."""
    path = [source]
    while path[-1] != sink:
        i = path[-1]
        best, to = INFINITE, -1
        for _, j, cost in arcs[i]:
            if cost + price[j] < best:
                best, to = cost + price[j], j
        if price[i] < best or to < 0:
            price[i] = best
            if len(path) > 1:
                path.pop()
            elif to < 0:
                return
        else:
            path.append(to)


def least_path(arcs: Arcs, source: int, sink: int, price: list[float]) -> tuple[int, list[str]] | None:
    """Cost and labels of the cheapest path, of several the one whose labels sort first; None if there is none.

    The tight arcs (price of tail = cost + price of head) hold every cheapest path. The trace follows the first tight arc whose
    head keeps its price when the auction goes on from there; a head whose price rises was no part of a cheapest path.
    """
    auction(arcs, source, sink, price)
    if price[source] == INFINITE:
        return None
    i, labels = source, []
    while i != sink:
        for label, j, cost in arcs[i]:
            if price[i] != cost + price[j]:
                continue
            if j != sink:
                auction(arcs, j, sink, price)
            if price[i] == cost + price[j]:
                labels.append(label)
                i = j
                break
    return int(price[source]), labels


def with_way(arcs: Arcs, sink: int) -> set[int]:
    """Nodes that the sink can be reached from."""
    before: list[list[int]] = [[] for _ in arcs]
    for i, own in enumerate(arcs):
        for _, j, _ in own:
            before[j].append(i)
    found, edge = {sink}, [sink]
    while edge:
        for i in before[edge.pop()]:
            if i not in found:
                found.add(i)
                edge.append(i)
    return found


# ---- the lattice of repairs --------------------------------------------------------------------------------------------

#: What the roles kept so far end with: nothing, a system turn, a user turn, an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
#: state -> role initial -> state: the roles of ``(s?(ua)+)?``, which may end in START and ASSISTANT.
MOVES: Mapping[int, Mapping[str, int]] = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
#: Faults of a row, in the order of their precedence.
CLEAN, BLANK, DUPLICATE, TRUNCATED = "0123"
DELETE_COST, REROLE_COST, INSERT_COST, TRUNCATED_COST = 4, 3, 3, 3


def added(state: int) -> str:
    """Initial of the only role that an insertion or a new role can bring in this state."""
    return "a" if state == USER else "u"


def row_steps(initial: str, fault: str) -> list[list[tuple[str, int, int]]]:
    """state -> (edit, next state, cost) for a row with this role initial and fault."""
    out = []
    for state in range(STATES):
        steps = [("D", state, DELETE_COST)]
        if fault not in (BLANK, DUPLICATE):
            more = TRUNCATED_COST if fault == TRUNCATED else 0
            if initial in MOVES[state]:
                steps.append(("K", MOVES[state][initial], more))
            steps.append(("R", MOVES[state][added(state)], REROLE_COST + more))
        out.append(steps)
    return out


def lattice(steps: Sequence[Sequence[Sequence[tuple[str, int, int]]]], inserts: Sequence[int], closed: bool) -> list[list[tuple[str, int, int]]]:
    """Arcs of the nodes layer * STATES + state. Layers in ``inserts`` have insertions; ``closed`` leads the last one to a sink."""
    last, may = len(steps), set(inserts)
    arcs: list[list[tuple[str, int, int]]] = []
    for layer in range(last + 1):
        for state in range(STATES):
            own = [(label, (layer + 1) * STATES + to, cost) for label, to, cost in steps[layer][state]] if layer < last else []
            if layer in may:
                own.append(("I", layer * STATES + MOVES[state][added(state)], INSERT_COST))
            if closed and layer == last and state in (START, ASSISTANT):
                own.append(("", (last + 1) * STATES, 0))
            arcs.append(sorted(own))
    return arcs + [[]] * closed


def row_lattice(codes: str, closed: bool) -> list[list[tuple[str, int, int]]]:
    """Lattice of rows given as initial and fault, two characters a row. An open one has no insertion after its last row."""
    steps = [row_steps(codes[i], codes[i + 1]) for i in range(0, len(codes), 2)]
    return lattice(steps, range(len(steps) + closed), closed)


def first_prices(arcs: Arcs, sink: int) -> list[float]:
    """Prices to start from: the least costs of the layers still to cross, infinite without a way to the sink.

    No arc costs less than the fall of these prices along it, so that the auction only has to add what insertions and the
    order of roles cost.
    """
    least: dict[int, int] = {}
    for i, own in enumerate(arcs):
        for _, j, cost in own:
            if j // STATES > i // STATES:
                layer = i // STATES
                least[layer] = min(least.get(layer, cost), cost)
    rest = [0] * (sink // STATES + 1)
    for layer in range(sink // STATES - 1, -1, -1):
        rest[layer] = rest[layer + 1] + least.get(layer, 0)
    ways = with_way(arcs, sink)
    return [rest[i // STATES] if i in ways else INFINITE for i in range(len(arcs))]


def whole(codes: str) -> tuple[int, str]:
    """Cost and edits of a whole conversation."""
    arcs = row_lattice(codes, True)
    cost, labels = least_path(arcs, START, len(arcs) - 1, first_prices(arcs, len(arcs) - 1))
    return cost, "".join(labels)


def crossings(codes: str) -> list[tuple[int, int, int, str]]:
    """(state before, state after, cost, edits) of every way through a part of a conversation."""
    arcs, out = row_lattice(codes, False), []
    for after in range(STATES):
        sink = len(arcs) - STATES + after
        price = first_prices(arcs, sink)  # prices serve all sources of one sink
        for before in range(STATES):
            found = least_path(arcs, before, sink, price)
            if found:
                out.append((before, after, found[0], "".join(found[1])))
    return out


def chain(parts: Sequence[Sequence[tuple[int, int, int, str]]]) -> tuple[int, list[str]]:
    """Cost of a conversation and the edits of each of its parts, from the parts' crossings.

    The edits of every way through a part end with a row's edit and hold one for each row, so that none is the beginning of
    another, and the least first part begins the least whole.
    """
    steps = [[[(edits, to, cost) for a, to, cost, edits in part if a == state] for state in range(STATES)] for part in parts]
    arcs = lattice(steps, [len(parts)], True)
    cost, labels = least_path(arcs, START, len(arcs) - 1, first_prices(arcs, len(arcs) - 1))
    return cost, [*labels[: len(parts) - 1], "".join(labels[len(parts) - 1 :])]
