"""Rendering, fallback and the slot fold against a slow restatement in plain Python."""

import json
import random
import re

from pyspark.sql import functions as F

from outreach.operators import slots
from outreach.operators.content import attribute_map, fill_variables, render_candidates, variable_cells
from outreach.operators.metadata import module_info

SLOTS = [1, 2, 3, 4]
SEED = 33
TEMPLATES = [
    "Hi", "d|%%traveler.city%%", "d|%%f.best%%|two", "", None, "d|x|%%traveler.seg%% y|z", "%%traveler.city%%|b",
    "d|Finance", "d|null value",
]


def module(rng, i):
    return {
        "id": i, "type": rng.randint(1, 4), "placement": rng.choice(["subject", "hero", "banner", "body"]),
        "default": rng.randint(0, 1), "templates": [rng.choice(TEMPLATES) for _ in range(2)],
    }


def expected(row, modules):
    """One content row the slow way."""
    def text(template):
        def value(m):
            table, column = m.group(1).split(".")
            v = row[column] if table == "traveler" else row["best"]
            return v or "value_not_found"
        return re.sub(r"%%([^%]+)%%", value, template or "")

    def cell(m, slot, position):
        parts = text(m["templates"][position - 1]).split("|")
        subject = slot == 1 and position == 1
        n = len(parts) - 1
        if n == 0:
            value = parts[0] if subject else "None"
        else:
            value = parts[1] if n == 1 else parts[1 + (row["test_keys"] + SEED % n) % n]
        low = value.lower()
        failed = "value_not_found" in low or low == "none" or bool(re.search(r"\b(nan|null)\b", low))
        if failed:
            value = parts[0] if subject else "None"
        return value, failed

    picks, used, worst, subject, shown = [], [], row["priority"], "None", {}
    for slot in SLOTS:
        offers = [(p, m) for s, p, m in row["offers"] if s == slot]
        open_offers = []
        for p, m in offers:
            if m in used:
                continue
            mod = modules[m]
            cells = [cell(mod, slot, i) for i in (1, 2)]
            spent = any(f for _, f in cells) and mod["placement"] in ("hero", "banner") and mod["default"] == 0
            open_offers.append((9999 if spent else p, m, cells))
        if not open_offers:
            picks.append((999, "pixel_module" if offers else "None"))
            continue
        priority, m, cells = min(open_offers, key=lambda o: o[:2])
        mod = modules[m]
        if priority == 9999 and mod["default"] == 0 and mod["placement"] == "hero":
            worst = 9999
        if priority == 9999 and mod["default"] == 0 and mod["placement"] == "banner":
            picks.append((999, None))
            continue
        used.append(m)
        picks.append((m, None))
        if slot == 1:
            subject = cells[0][0]
        for template in mod["templates"]:
            for table, column in re.findall(r"%%(\w+)\.(\w+)%%", template or ""):
                v = row[column] if table == "traveler" else row["best"]
                if v and v.lower() not in ("nan", "none", "value_not_found"):
                    shown[f"{column}_1" if table == "traveler" else f"{column}_{m % 2 + 1}"] = v
    code = "_".join(f"{s}-{m}" for s, (m, _) in zip(SLOTS, picks))
    return code, [r for _, r in picks], worst, subject, shown


def test_decisions_equal_the_slow_version(spark):
    rng = random.Random(11)
    modules = {i: module(rng, i) for i in [*range(1, 25), 12, 123]}
    rows = []
    for i in range(150):
        offers = {}
        for _ in range(rng.randint(0, 9)):
            slot, m = rng.choice(SLOTS), rng.choice(list(modules))
            offers[(slot, m)] = rng.choice([1, 2, 2, 3, 9])
        rows.append({
            "i": i, "city": rng.choice(["Rome", "", None]), "seg": rng.choice(["A", None, "nan"]),
            "best": rng.choice(["Inn", None]), "test_keys": rng.randint(0, 99), "priority": rng.randint(1, 5),
            "offers": [(s, p, m) for (s, m), p in offers.items()],
        })
    variables = spark.createDataFrame(
        [(0, 0, "l", m["id"], n + 1, m["id"] % 2 + 1, "traveler.city|f.city", t)
         for m in modules.values() for n, t in enumerate(m["templates"])],
        "tpid int, eapid int, locale string, module_id int, var_position int, source_connection int, "
        "var_source string, var_structure string",
    )
    offers = spark.createDataFrame(
        [(r["i"], s, p, m, modules[m]["type"], modules[m]["placement"], modules[m]["default"])
         for r in rows for s, p, m in r["offers"]],
        "campaign_id int, slot int, priority int, module_id int, module_type_id int, placement_type string, default_flag int",
    ).join(module_info(variables).select("module_id", "variables"), "module_id")
    entry = F.struct("slot", "priority", "module_id", "module_type_id", "placement_type", "default_flag", "variables")
    arrays = offers.groupBy("campaign_id").agg(F.collect_list(entry).alias("candidates"))
    content = spark.createDataFrame(
        [(0, 0, "l", r["city"], r["seg"], r["i"], r["test_keys"], r["priority"]) for r in rows],
        "tpid int, eapid int, locale string, city string, seg string, campaign_id int, test_keys int, priority int",
    ).join(arrays, "campaign_id")
    # the look-up result is given here: one profile per row, told apart by its campaign
    look = spark.createDataFrame(
        [(r["i"], {"traveler.city|f.city": {"best": r["best"]}}) for r in rows],
        "campaign_id int, look_ups map<string,map<string,string>>",
    )
    keyed = content.withColumn("locale", F.col("campaign_id").cast("string"))
    profiles = (
        keyed.select("tpid", "eapid", "locale", "city", "seg", "campaign_id")
        .withColumn("attributes", attribute_map(["city", "seg"])).join(look, "campaign_id").drop("campaign_id")
    )
    rendered = render_candidates(keyed, profiles, ["city", "seg"], SEED)
    slot_frame = spark.createDataFrame([(SLOTS,)], "slots array<int>")
    picked = slots.pick_slots(rendered, slot_frame).select(
        "campaign_id", "campaign_priority",
        slots.module_code(F.col("picks")).alias("code"),
        F.transform("picks", lambda p: p["fill_reason"]).alias("reasons"),
        slots.subject_line(F.col("picks")).alias("subject"),
        slots.dynamic_content(F.col("picks")).alias("shown"),
    )
    got = {r.campaign_id: r for r in picked.collect()}
    with_offers = [r for r in rows if r["offers"]]
    assert len(got) == len(with_offers)
    for r in with_offers:
        code, reasons, worst, subject, shown = expected(r, modules)
        g = got[r["i"]]
        assert (g.code, g.reasons, g.campaign_priority, g.subject) == (code, reasons, worst, subject), r
        assert json.loads(g.shown) == shown, r
        chosen = [e.split("-")[1] for e in g.code.split("_")]
        real = [m for m in chosen if m != "999"]
        assert len(real) == len(set(real))


def test_single_option_cells(spark):
    """A lone option is shown as the subject only; anywhere else it is unresolved."""
    df = spark.createDataFrame(
        [(0, 0, "l", 1, 1, 1, "", "Hello")],
        "tpid int, eapid int, locale string, module_id int, var_position int, source_connection int, "
        "var_source string, var_structure string",
    )
    empty = F.create_map().cast("map<string,string>")
    filled = fill_variables(F.col("variables"), empty, F.create_map().cast("map<string,map<string,string>>"))
    def cells(slot):
        return variable_cells(filled, F.lit(0), F.lit(SEED), F.lit(slot))[0].alias(f"s{slot}")

    r = module_info(df).select(cells(1), cells(2)).first()
    assert (r.s1.value, r.s1.option, r.s1.failed) == ("Hello", "default", False)
    assert (r.s2.value, r.s2.option, r.s2.failed) == ("None", "default", True)
