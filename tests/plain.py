"""Plain folds of one meeting's rows, against which the distributed ones are held."""


def _seconds(a: float, b: float) -> float:
    """From a to b, to the millisecond, so that limits are met exactly."""
    return round(b - a, 3)


def _joined(a: str, b: str) -> str:
    return f"{a} {b}".strip()


def chunk_turns(rows: list[dict], gap: float = 1.2, cap: float = 35.0, most: int = 650) -> list[dict]:
    """As W1, and a turn of `most` characters that ends a sentence is closed too."""
    out: list[dict] = []
    for r in rows:
        last = out[-1] if out else None
        if last and last["speaker"] == r["speaker"] and _seconds(last["end"], r["start"]) <= gap and _seconds(last["start"], last["end"]) < cap and not (len(last["text"]) >= most and last["text"][-1:] in tuple(".!?")):
            last |= {"end": max(last["end"], r["end"]), "text": _joined(last["text"], r["text"]), "n": last["n"] + 1}
        else:
            out.append({**r, "n": 1})
    return out


def chunk_cues(rows: list[dict], cap: float = 30.0, most: int = 650) -> list[dict]:
    """Cues in chunks, closed by a new speaker, a change of the hint in force, or a chunk that is long enough; empty cues only change the hint."""
    out: list[dict] = []
    hint, held = "", None
    for r in rows:
        if r["new_speaker"]:
            hint = ""
        if r["speaker_hint"]:
            hint = r["speaker_hint"]
        text = (r["text"] or "").strip()
        if held and (r["new_speaker"] or hint != held["speaker"] or held["end"] - held["start"] >= cap or len(held["text"]) >= most and held["text"][-1:] in tuple(".!?")):
            out.append(held)
            held = None
        if not text:
            continue
        if held:
            held |= {"end": r["end"], "text": _joined(held["text"], text), "n": held["n"] + 1}
        else:
            held = {**r, "speaker": hint, "text": text, "n": 1}
    return out + ([held] if held else [])


def capped_merge(rows: list[dict], gap: float = 2.0, span: float = 120.0) -> list[dict]:
    """W4, third form: neighbours of one speaker and status with a gap under `gap` merge while the whole lasts `span` at most."""
    out: list[dict] = []
    for r in rows:
        last = out[-1] if out else None
        if last and (last["speaker"], last["status"]) == (r["speaker"], r["status"]) and r["start"] - last["end"] < gap and r["end"] - last["start"] <= span:
            last |= {"end": max(last["end"], r["end"]), "text": _joined(last["text"], r["text"]), "n": last["n"] + 1}
        else:
            out.append({**r, "n": 1})
    return out


def carry_speakers(rows: list[dict], lead: int = 100, phrases=("i ", "we ", "the ", "this ", "our ", "to the", "ask ", "please ", "will now")) -> list[dict]:
    """W12."""
    out, chair = [], ""
    for r in rows:
        if r["status"] == "chair":
            chair = r["speaker"]
        elif r["speaker"] not in ("", "Unknown Speaker"):
            chair = ""
        elif chair and any(p in r["text"].lower()[:lead] for p in phrases):
            r = {**r, "speaker": chair, "status": "heuristic"}
        out.append(dict(r))
    return out
