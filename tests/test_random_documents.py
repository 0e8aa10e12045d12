"""Random documents, well formed and not: each is made together with the alerts it must give."""

import json
import random
from decimal import Decimal

from walletscope.operators import alerts

COLUMNS = ("event_id string, chain string, provider string, address string, lt bigint, tx_hash string, "
           "correlation_id string, raw_json string")
#: What a part gives that makes its whole document impossible to evaluate.
WRONG = "wrong"
#: Values of any kind, by what they are.
ODD = {"null": "null", "int": "5", "bool": "true", "text": '"text"', "list": "[]", "object": "{}", "real": "1.5"}


class Maker:
    """Makes (text, outcome) pairs; an outcome is a list of alerts, or WRONG."""

    def __init__(self, seed):
        self.rng = random.Random(seed)

    def odd(self, fits, otherwise):
        """Any value; ``fits`` has the outcomes of the kinds that are fine here."""
        kind = self.rng.choice(list(ODD))
        return ODD[kind], fits.get(kind, otherwise)

    def value(self):
        """(text, nano amount, None for none, or WRONG)."""
        nano = self.rng.randint(1, 400) * 10**9
        return self.rng.choice([
            lambda: (str(nano), nano), lambda: (f'"{nano}"', nano), lambda: ('"100000000000"', 100 * 10**9),
            lambda: ('" 150000000000 "', 150 * 10**9), lambda: ('"1e12"', None), lambda: ('"-150000000000"', -150 * 10**9),
            lambda: ('"' + "9" * 31 + '"', WRONG), lambda: ("1e12", None), lambda: self.odd({}, None)])()

    def address(self):
        """(text, address shown, or WRONG)."""
        chain, chain_shown = self.odd({"int": "5:AB", "real": "AB"}, WRONG)
        raw, raw_shown = self.odd({"null": "unknown", "text": "text"}, WRONG)
        return self.rng.choice([
            lambda: ('"0:SOURCEADDRESS"', "0:SOURCEADDRESS"), lambda: ('"A:B"', "A:B"),
            lambda: ('{"workchain_id":0,"address":"EQABCDEFGHIJ"}', "0:EQABCDEFGHIJ"),
            lambda: ('{"address":"AB","workchain_id":-1}', "-1:AB"), lambda: ('{"raw_form":"R"}', "R"),
            lambda: ('{"address":"","raw_form":"R"}', "R"), lambda: (f'{{"address":"AB","workchain_id":{chain}}}', chain_shown),
            lambda: (f'{{"raw_form":{raw}}}', raw_shown), lambda: self.odd({"text": "text"}, "unknown")])()

    def fields(self, pairs):
        self.rng.shuffle(pairs)
        return "{" + ",".join(f'"{k}":{v}' for k, v in pairs) + "}"

    def message(self, direction):
        if self.rng.random() < 0.06:
            return self.odd({"object": []}, WRONG)
        made = {"value": self.value(), "source": self.address(), "destination": self.address()}
        made = {k: v for k, v in made.items() if self.rng.random() < 0.7}
        text = self.fields([(k, t) for k, (t, _) in made.items()])
        shown = {k: made[k][1] if k in made else "unknown" for k in ("source", "destination")}
        nano = made["value"][1] if "value" in made else None
        if nano is WRONG:
            return text, WRONG
        if nano is None or nano < 100 * 10**9:
            return text, []
        if WRONG in shown.values():
            return text, WRONG
        other = shown["source"] if direction == "IN" else shown["destination"]
        other = other[:10] + "..." if len(other) > 10 else other
        said = ("Received from " if direction == "IN" else "Sent to ") + other
        return text, [(direction, Decimal(nano) / 10**9, said)]

    def listed(self, make, most):
        parts = [make() for _ in range(self.rng.randint(0, most))]
        return "[" + ",".join(t for t, _ in parts) + "]", together(o for _, o in parts)

    def transaction(self):
        if self.rng.random() < 0.04:
            return self.odd({"object": []}, WRONG)
        pairs, incoming, outgoing = [], [], []
        if self.rng.random() < 0.7:
            text, incoming = self.message("IN")
            pairs.append(("in_msg", text))
        if self.rng.random() < 0.6:
            text, outgoing = (self.odd({"list": []}, WRONG) if self.rng.random() < 0.05
                              else self.listed(lambda: self.message("OUT"), 3))
            pairs.append(("out_msgs", text))
        if self.rng.random() < 0.3:
            pairs.append(("note", self.odd({}, None)[0]))
        return self.fields(pairs), together([incoming, outgoing])

    def document(self):
        if self.rng.random() < 0.05:
            return self.odd({"object": []}, WRONG)
        if self.rng.random() < 0.5:
            return self.transaction()
        text, outcome = (self.odd({"list": []}, WRONG) if self.rng.random() < 0.05
                         else self.listed(self.transaction, 3))
        beside = [("in_msg", self.odd({}, None)[0]), ("out_msgs", self.odd({}, None)[0]), ("lt", "7")]
        return self.fields([("transactions", text)] + self.rng.sample(beside, self.rng.randint(0, 2))), outcome

    def delivered(self):
        """A document as it arrives: (text, status, alerts); some are damaged so that they are no JSON."""
        text, outcome = self.document()
        if self.rng.random() < 0.12 and len(text) > 2:
            cut = self.rng.randrange(1, len(text))
            broken = self.rng.choice([text[:cut], text + " tail", text[:cut] + text[cut + 1:], text + text])
            if not is_json(broken):
                return broken, "raw_json_parse_error", []
        if self.rng.random() < 0.03:
            text = f" {text}\n"
        return (text, "evaluation_error", []) if outcome is WRONG else (text, "ok", outcome)


def together(outcomes):
    outcomes = list(outcomes)
    return WRONG if WRONG in outcomes else [hit for found in outcomes for hit in found]


def is_json(text):
    try:
        json.loads(text)
    except ValueError:
        return False
    return True


def test_random_documents(spark):
    maker = Maker(20)
    made = [maker.delivered() for _ in range(6000)]
    df = spark.createDataFrame([(str(i), "ton", "tonapi", "A", 1, "h", "c", t) for i, (t, _, _) in enumerate(made)],
                               COLUMNS)
    judged = {int(r.event_id): r for r in alerts.evaluate(df).collect()}
    listed = {}
    for r in alerts.whale_alerts(df).orderBy("event_id", "position").collect():
        listed.setdefault(int(r.event_id), []).append((r.direction, r.amount, r.message))
    seen = set()
    for i, (text, status, hits) in enumerate(made):
        row = judged[i]
        assert row.status == status, (text, row.status, status)
        assert [(h.direction, h.amount, h.message) for h in row.hits or []] == hits, text
        assert listed.get(i, []) == hits, text
        seen.add((status, bool(hits)))
    assert len(seen) == 4
