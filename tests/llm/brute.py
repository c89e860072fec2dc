"""Plain versions that tests compare with."""


def parts_of(nodes, links):
    """The smallest node that each node reaches."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {n: find(n) for n in nodes}
