"""Tree ensembles as tables of nodes, scored by column expressions or SQL without the model's own code.

A node is (tree, node, feature, threshold, left, right, value, weight): rows whose feature is at most the threshold go left.
A leaf has no feature and a value. A split of categories is told by `categories`, those that go left. Ensembles are small:
their size follows from the number and depth of trees, not from the data.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.sql import Column, functions as F


class TreeNode(NamedTuple):
    tree: int
    node: int
    feature: int | None
    threshold: float | None
    left: int | None
    right: int | None
    value: float | None
    weight: float
    categories: tuple[float, ...] | None = None


def tree_nodes(model: GBTClassificationModel | RandomForestClassificationModel) -> list[TreeNode]:
    """The nodes of a fitted ensemble. A leaf's value is the tree's prediction, or for a forest its share of class 1."""
    forest = isinstance(model, RandomForestClassificationModel)
    out: list[TreeNode] = []
    for tree, (fitted, weight) in enumerate(zip(model.trees, model.treeWeights, strict=True)):
        waiting, used = [(0, fitted._java_obj.rootNode())], 1
        while waiting:
            number, node = waiting.pop()
            if node.subtreeDepth() == 0:
                shares = list(node.impurityStats().stats()) if forest else []
                value = shares[1] / sum(shares) if forest else node.prediction()
                out.append(TreeNode(tree, number, None, None, None, None, value, weight))
                continue
            split, categories, threshold = node.split(), None, None
            if split.getClass().getSimpleName() == "CategoricalSplit":
                categories = tuple(split.leftCategories())
            else:
                threshold = split.threshold()
            out.append(TreeNode(tree, number, split.featureIndex(), threshold, used, used + 1, None, weight, categories))
            waiting += [(used, node.leftChild()), (used + 1, node.rightChild())]
            used += 2
    return sorted(out)


def _folded(nodes: Sequence[TreeNode], leaf: Callable, choose: Callable) -> list:
    """(weight, expression) of each tree, built from its leaves up."""
    trees: dict[int, dict[int, TreeNode]] = {}
    for n in nodes:
        trees.setdefault(n.tree, {})[n.node] = n
    out = []
    for tree in trees.values():
        made: dict[int, object] = {}
        for number in sorted(tree, reverse=True):  # children have greater numbers
            n = tree[number]
            made[number] = leaf(n.value) if n.feature is None else choose(n, made.pop(n.left), made.pop(n.right))
        out.append((tree[0].weight, made[0]))
    return out


def margin(nodes: Sequence[TreeNode], feature: Callable[[int], Column]) -> Column:
    """The weighted sum over all trees. `feature` gives the column of a feature by its number."""

    def choose(n: TreeNode, left: Column, right: Column) -> Column:
        x = feature(n.feature)
        return F.when(x.isin(list(n.categories)) if n.categories is not None else x <= n.threshold, left).otherwise(right)

    total = F.lit(0.0)
    for weight, tree in _folded(nodes, F.lit, choose):
        total += F.lit(weight) * tree
    return total


def boosted_probability(nodes: Sequence[TreeNode], feature: Callable[[int], Column]) -> Column:
    """Probability of class 1 by boosted trees with logistic loss."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * margin(nodes, feature)))


def forest_probability(nodes: Sequence[TreeNode], feature: Callable[[int], Column]) -> Column:
    """Probability of class 1 by a random forest: the mean of the trees' shares."""
    return margin(nodes, feature) / F.lit(float(sum({n.tree: n.weight for n in nodes}.values())))


def margin_sql(nodes: Sequence[TreeNode], feature: Callable[[int], str]) -> str:
    """The weighted sum over all trees as a SQL CASE expression."""

    def choose(n: TreeNode, left: str, right: str) -> str:
        x = feature(n.feature)
        test = f"{x} in ({', '.join(map(repr, n.categories))})" if n.categories is not None else f"{x} <= {n.threshold!r}::double"
        return f"case when {test} then {left} else {right} end"

    return " + ".join(f"{w!r}::double * {tree}" for w, tree in _folded(nodes, lambda v: f"{v!r}::double", choose))
