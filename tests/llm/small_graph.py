"""Components of a small graph, by passing least names along links until nothing changes."""


def components_of(names, links):
    label = list(names)
    changed = True
    while changed:
        changed = False
        for i, j in links:
            if label[i] != label[j]:
                label[i] = label[j] = min(label[i], label[j])
                changed = True
    return label
