"""The semantics once more in plain Python, row by row, to compare with."""


def encode_turns(template, specials, encode, turns, system=None, eos_per_turn=None):
    """[(source ids, target ids)] of one conversation."""
    from sftprep.functions.templates import Special

    bos = [specials.bos_id] if specials.bos_token and specials.add_bos_token else []
    eos = [] if template.efficient_eos else [specials.eos_id]
    system = system or template.system

    def ids(elements, **slots):
        out = []
        for e in elements:
            if isinstance(e, Special):
                out.append(specials.special_id(e.name))
            else:
                for name, value in slots.items():
                    e = e.replace("{{" + name + "}}", value, 1)
                out += encode(e)
        return out

    result = []
    for i, (q, r) in enumerate(turns):
        if template.system_in_query:
            if i == 0:
                q = template.prefix[0].replace("{{system}}", system) + q
            lead, prompt = bos, ids(template.prompt, query=q)
        else:
            head = ids(template.prefix, system=system)
            sep = ids(template.sep)
            lead = (bos + head + sep if head else bos) if i == 0 else sep + bos
            prompt = ids(template.prompt, query=q, idx=str(i))
        result.append((lead + prompt, encode(r) + eos))
    return result


def supervised(template, specials, encode, turns, system, cutoff, train_on_prompt=False):
    ids, labels = [], []
    for i, (s, t) in enumerate(encode_turns(template, specials, encode, turns, system)):
        n = len(s) + len(t)
        s, t = s[: int(cutoff * (len(s) / n))], t[: int(cutoff * (len(t) / n))]
        labels += mask(s, i, template, specials, train_on_prompt) + t
        ids += s + t
    if template.efficient_eos:
        ids, labels = ids + [specials.eos_id], labels + [specials.eos_id]
    if len(ids) > cutoff:
        ids, labels = ids[:cutoff], labels[:cutoff]
    return ids, labels


def mask(s, i, template, specials, train_on_prompt=False):
    if train_on_prompt:
        return list(s)
    if i and template.efficient_eos:
        return [specials.eos_id] + [-100] * (len(s) - 1)
    return [-100] * len(s)


def packed(conversations, template, specials, encode, block, pack_rows):
    """Blocks (group, number, ids, labels) of [(row_idx, turns)]."""
    out = []
    groups = {}
    for row_idx, turns in conversations:
        groups.setdefault(row_idx // pack_rows, []).append(turns)
    for g, members in sorted(groups.items()):
        ids, labels = [], []
        for turns in members:
            for i, (s, t) in enumerate(encode_turns(template, specials, encode, turns)):
                ids += s + t
                labels += mask(s, i, template, specials) + t
        if template.efficient_eos:
            ids, labels = ids + [specials.eos_id], labels + [specials.eos_id]
        for b in range(len(ids) // block):
            out.append((g, b, ids[b * block : (b + 1) * block], labels[b * block : (b + 1) * block]))
    return out


def weighted(uniform, sizes, probabilities, over):
    """[(source, row)] by walking through the draws."""
    import numpy as np

    cdf = np.cumsum(probabilities)
    cdf = cdf / cdf[-1]
    at, done, out, slot = [0] * len(sizes), [False] * len(sizes), [], 0
    while not (all(done) if over else any(done)):
        s = int(np.searchsorted(cdf, uniform(slot), side="right"))
        out.append((s, at[s]))
        at[s] += 1
        if at[s] >= sizes[s]:
            done[s], at[s] = True, 0
        slot += 1
    return out
