"""Plain versions of what the operators compute, for small inputs."""

from __future__ import annotations


def reach(nodes, links):
    """The smallest node that each node reaches."""
    of = {node: node for node in nodes}

    def root(x):
        while of[x] != x:
            x = of[x]
        return x

    for a, b in links:
        p, q = root(a), root(b)
        of[max(p, q)] = min(p, q)
    return {node: root(node) for node in nodes}


def by_id(df, column, *columns):
    return {row[column]: tuple(row[name] for name in columns) for row in df.collect()}
