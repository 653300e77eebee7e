"""Layered YAML settings: files merge from left to right, single values are set by path, components are built by class path."""

from __future__ import annotations

import copy
import importlib
import inspect
import os
from typing import Any

Tree = dict[str, Any]


def _by_name(items: list, what: str) -> dict[str, Tree]:
    out: dict[str, Tree] = {}
    for item in items:
        name = item.get("name") if isinstance(item, dict) else None
        if not isinstance(name, str) or not name:
            raise ValueError(f"every {what} needs a name")
        if name in out:
            raise ValueError(f"two entries of a list of {what}s are named {name}")
        out[name] = item
    return out


def _layer_value(key: str, below: Any, above: Any) -> Any:
    if isinstance(below, dict) and isinstance(above, dict):
        return layer(below, above)
    both_lists = isinstance(below, list) and isinstance(above, list)
    if both_lists and key == "pipelines":
        old, new = _by_name(below, "pipeline"), _by_name(above, "pipeline")
        return [layer(old.get(n, {}), new.get(n, {})) for n in {**old, **new}]
    if both_lists and key == "postprocess" and above:  # an empty list clears the steps
        shared = [_layer_value("", b, a) for b, a in zip(below, above, strict=False)]
        return shared + copy.deepcopy([*below[len(shared) :], *above[len(shared) :]])
    return copy.deepcopy(above)


def layer(below: Tree, above: Tree) -> Tree:
    """Maps merge by key, pipelines by name, postprocess steps by place. Another class_path replaces its whole component."""
    if "class_path" in above and above["class_path"] != below.get("class_path"):
        return copy.deepcopy(above)
    fixed = {k: copy.deepcopy(v) for k, v in below.items() if k not in above}
    mixed = {k: _layer_value(k, below[k], v) if k in below else copy.deepcopy(v) for k, v in above.items()}
    return {k: mixed[k] if k in mixed else fixed[k] for k in (*below, *(k for k in above if k not in below))}


def _step(node: Any, part: str, path: str) -> Any:
    """The key or index under which a part of a path is found in node."""
    if isinstance(node, dict) and part in node:
        return part
    if isinstance(node, list):
        fit = [int(part)] if part.isdigit() else [k for k, item in enumerate(node) if isinstance(item, dict) and item.get("name") == part]
        if len(fit) == 1 and fit[0] < len(node):
            return fit[0]
    raise ValueError(f"{path}: {part!r} names nothing, or more than one thing")


def set_value(tree: Tree, assignment: str) -> Tree:
    """PATH=YAML: parts of the path are keys, indexes or names of list items. Only what exists can be set."""
    import yaml

    path, equals, text = assignment.partition("=")
    parts = path.split(".")
    if not equals or not all(parts):
        raise ValueError(f"{assignment!r} is not PATH=VALUE")
    out = copy.deepcopy(tree)
    node: Any = out
    for part in parts[:-1]:
        node = node[_step(node, part, path)]
    if isinstance(node, list) and not parts[-1].isdigit():
        raise ValueError(f"{path} names a list's item, not a value")
    node[_step(node, parts[-1], path)] = yaml.safe_load(text)
    return out


def read(paths: list[str], assignments: list[str] | None = None) -> Tree:
    import yaml

    tree: Tree = {}
    for path in paths:
        with open(path, encoding="utf-8") as f:
            tree = layer(tree, yaml.safe_load(f) or {})
    for assignment in assignments or []:
        tree = set_value(tree, assignment)
    return tree


def build(component: Tree, base: type) -> Any:
    """The object that class_path and init_args describe, which must be of the base class and take just these arguments."""
    if unknown := sorted(set(component) - {"class_path", "init_args"}):
        raise ValueError(f"a component has no {unknown}")
    module, _, name = component["class_path"].rpartition(".")
    kind = getattr(importlib.import_module(module), name)
    if not (inspect.isclass(kind) and issubclass(kind, base)):
        raise ValueError(f"{component['class_path']} is no {base.__name__}")
    args = component.get("init_args") or {}
    try:
        inspect.signature(kind).bind(**args)
    except TypeError as e:
        raise ValueError(f"{component['class_path']}: {e}") from e
    return kind(**args)


def output_folder(named: str | None, targets: list[str | None], workspace: str) -> str:
    """The named folder; else the one that all targets lie in; else output in the workspace where no region has a target."""
    if named is not None:
        return os.path.abspath(os.path.join(workspace, named))
    parents = {os.path.dirname(os.path.abspath(t)) if t else None for t in targets}
    if parents <= {None}:
        return os.path.abspath(os.path.join(workspace, "output"))
    if len(parents) > 1:
        raise ValueError("the regions do not share a folder; name one with output_dir")
    return parents.pop()
