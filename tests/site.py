"""Pages of a made-up results site, built from plain rows, with the markup that the extraction expects."""

INDEX = "http://site.test/events?page=all"


def index_page(events):
    """Events newest first; the first row of the table is a head row."""
    body = '<tr class="b-statistics__table-row"><td class="b-statistics__table-col"></td></tr>'
    for name, date, place, link in events:
        anchor = f'<a href="{link}" class="b-link b-link_style_black">\n  {name}\n</a>' if link else name
        day = f'<span class="b-statistics__date">\n {date}\n</span>' if date else ""
        body += (
            f'<tr class="b-statistics__table-row"><td class="b-statistics__table-col"><i>{anchor}{day}</i></td>'
            '<td class="b-statistics__table-col b-statistics__table-col_style_big-top-padding">'
            f"\n  {place}\n</td></tr>"
        )
    return f"<html><body><table><thead><tr><th>Name</th></tr></thead><tbody>{body}</tbody></table></body></html>"


def directory_page(fighters):
    """Fighter rows of 11 cells; a row given as text is inserted as it is."""
    body = ""
    for f in fighters:
        if isinstance(f, str):
            body += f
            continue
        first, last, nick, height, weight, reach, stance, wins, losses, draws, belt, link = f
        texts = [f'<a href="{link}" class="b-link">{first}</a>', last, nick, height, weight, reach, stance]
        texts += [wins, losses, draws, '<img src="/belt.png">' if belt else ""]
        cells = "".join(f'<td class="b-statistics__table-col">\n {t} \n</td>' for t in texts)
        body += f'<tr class="b-statistics__table-row">{cells}</tr>'
    return f"<html><table><tbody>{body}</tbody></table></html>"


def event_page(fights):
    body = '<tr class="b-fight-details__table-row b-fight-details__table-row__head"><th>W/L</th></tr>'
    for flag, one, two, weight, method, how, rnd, clock, marks, link in fights:
        people = "".join(f'<p><a class="b-link b-link_style_black" href="/f">\n {x} </a></p>' for x in (one, two))
        icons = "".join(f'<img src="/{m}">' for m in marks)
        stats = "".join('<td class="b-fight-details__table-col"><p>1</p><p>2</p></td>' for _ in range(4))
        target = f' data-link="{link}"' if link else ""
        body += (
            f'<tr class="b-fight-details__table-row js-fight"{target}>'
            f'<td class="b-fight-details__table-col"><p><a href="#"><i class="b-flag"><i class="b-flag__text">{flag}</i>'
            f"</i></a></p></td><td>{people}</td>{stats}"
            f"<td><p> {weight} {icons}</p></td><td><p> {method} </p><p>\n{how}\n</p></td><td><p>{rnd}</p></td><td><p> {clock}</p></td></tr>"
        )
    return f"<html><table><tbody>{body}</tbody></table></html>"


def _cells(columns):
    lines = ["".join(f"<p class='b-text'>\n {line}\n </p>" for line in c) for c in columns]
    return "".join(f'<td class="b-fight-details__table-col">{x}</td>' for x in lines)


def _section(rows):
    """Rows of one fight, transposed into cells with one line per fighter."""
    return f'<tr class="b-fight-details__table-row">{_cells(list(zip(*rows)))}</tr>'


def _table(body):
    return f'<table><thead><tr><th>Fighter</th></tr></thead><tbody class="b-fight-details__table-body">{body}</tbody></table>'


def _rounds(rounds):
    parts = []
    for label, rows in rounds:
        head = f'<thead class="b-fight-details__table-row"><tr><th colspan="10">\n {label} </th></tr></thead>'
        parts.append(head + _section(rows))
    return "".join(parts)


def fight_page(totals, strikes, round_totals, round_strikes):
    """`totals`: rows (fighter, nine values). `strikes`: rows (fighter, six values); two more columns precede them."""

    def wide(rows):
        return [(r[0], "x", "y", *r[1:]) for r in rows]

    return (
        "<html><body>"
        + _table(_section(totals))
        + _table(_rounds(round_totals))
        + _table(_section(wide(strikes)))
        + _table(_rounds([(label, wide(rows)) for label, rows in round_strikes]))
        + "</body></html>"
    )
