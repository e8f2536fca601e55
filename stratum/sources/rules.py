"""Rule files -> rule dicts for ``stratum.operators.quality``.

Two YAML shapes are read:

* expectation files: ``rules: [{column, dimension, threshold, ignoreNull,
  nonNullExpectation | uniquenessExpectation | rangeExpectation |
  regexExpectation | rowConditionExpectation}]``;
* model test files: ``models: [{name, columns: [{name, tests: [not_null,
  unique, accepted_values, relationships, ...accepted_range]}]}]``.
"""

from __future__ import annotations

from pathlib import Path

try:  # optional dependency; only rule-file loading needs it
    import yaml
except ImportError:  # pragma: no cover
    yaml = None


def _load(text_or_path) -> dict:
    if yaml is None:
        raise RuntimeError("PyYAML is required to read rule files")
    p = Path(str(text_or_path))
    text = p.read_text() if "\n" not in str(text_or_path) and p.exists() else str(text_or_path)
    return yaml.safe_load(text) or {}


def _number(v):
    if v is None:
        return None
    f = float(v)
    return int(f) if f.is_integer() and "." not in str(v) else f


def expectation_rules(text_or_path) -> list[dict]:
    """Expectation-style rule file -> rule dicts."""
    out = []
    for r in _load(text_or_path).get("rules", []):
        rule = {"column": r["column"], "dimension": r.get("dimension"),
                "threshold": float(r.get("threshold", 1.0)),
                "ignore_null": bool(r.get("ignoreNull", False))}
        if "nonNullExpectation" in r:
            rule["kind"] = "not_null"
        elif "uniquenessExpectation" in r:
            rule["kind"] = "unique"
        elif "rangeExpectation" in r:
            e = r["rangeExpectation"] or {}
            rule.update(kind="range", min=_number(e.get("minValue")), max=_number(e.get("maxValue")),
                        min_inclusive=not e.get("strictMinEnabled"), max_inclusive=not e.get("strictMaxEnabled"))
        elif "regexExpectation" in r:
            rule.update(kind="regex", regex=r["regexExpectation"]["regex"])
        elif "rowConditionExpectation" in r:
            rule.update(kind="row_condition", expression=r["rowConditionExpectation"]["sqlExpression"])
        else:
            raise ValueError(f"unsupported rule {r}")
        out.append(rule)
    return out


def model_test_rules(text_or_path, parents: dict | None = None) -> dict[str, list[dict]]:
    """Model-test file -> {model name: rule dicts}. ``parents`` maps a model
    name to its DataFrame for ``relationships`` tests."""
    parents = parents or {}
    doc = _load(text_or_path)
    models = doc.get("models", []) + [t for s in doc.get("sources", []) for t in s.get("tables", [])]
    out: dict[str, list[dict]] = {}
    for m in models:
        rules = []
        for c in m.get("columns", []):
            for t in c.get("tests", []) or []:
                name, args = (t, {}) if isinstance(t, str) else next(iter(t.items()))
                args = args or {}
                base = {"column": c["name"], "where": args.get("where"), "threshold": 1.0}
                if name == "not_null":
                    rules.append({**base, "kind": "not_null", "dimension": "COMPLETENESS"})
                elif name == "unique":
                    rules.append({**base, "kind": "unique", "dimension": "UNIQUENESS"})
                elif name == "accepted_values":
                    rules.append({**base, "kind": "accepted_values", "values": list(args["values"]),
                                  "dimension": "VALIDITY"})
                elif name.endswith("accepted_range"):
                    rules.append({**base, "kind": "range", "min": args.get("min_value"),
                                  "max": args.get("max_value"),
                                  "inclusive": args.get("inclusive", True),
                                  # the test returns rows beyond a bound, so NULL passes
                                  "ignore_null": True, "dimension": "VALIDITY"})
                elif name == "relationships":
                    target = args["to"].split("'")[1] if "'" in args["to"] else args["to"]
                    if target not in parents:
                        raise KeyError(f"relationships test of {m['name']}.{c['name']} needs the table {target}")
                    rules.append({**base, "kind": "relationship", "parent": parents[target],
                                  "parent_name": target, "parent_column": args["field"],
                                  "dimension": "CONSISTENCY"})
                else:
                    raise ValueError(f"unsupported test {name}")
        out[m["name"]] = rules
    return out
