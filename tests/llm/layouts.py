"""Hand-made pages: ten layouts around five kinds of articles, with what the main text is."""

PROSE = ["The river rose by two metres during the night and flooded the lower part of the old town.",
         "Volunteers carried sandbags to the bridge while the council opened the sports hall for families.",
         "Engineers expect the water to fall again before the weekend, if the rain stops as forecast."]
BODIES = {
    "prose": [("h1", "Flood in the old town"), *[("p", x) for x in PROSE]],
    "list": [("h1", "How to prepare for a flood"), ("p", PROSE[0]), ("h2", "What to keep at hand"),
             ("ul", ["Drinking water for three days", "A torch and spare batteries", "Copies of important papers"]),
             ("p", PROSE[1])],
    "code": [("h1", "Reading the gauge from a script"), ("p", "The gauge writes one line per minute to a file on the server."),
             ("pre", "import csv rows = csv.reader(open(path)) for row in rows: print(row[0])"),
             ("p", "The loop prints the time of each line, which is enough to find gaps in the data.")],
    "table": [("h1", "Levels of the week"), ("p", PROSE[2]),
              ("table", [["Day", "Level"], ["Monday", "3.2 metres"], ["Tuesday", "4.1 metres"]]), ("p", PROSE[0])],
    "quote": [("h1", "What the mayor said"), ("p", PROSE[1]), ("blockquote", "We have never seen the water rise so fast."),
              ("h2", "Next steps"), ("p", PROSE[2])],
}
NAV = "<nav><ul><li><a href='/'>Home</a></li><li><a href='/n'>News</a></li><li><a href='/c'>Contact</a></li></ul></nav>"
DIV_NAV = "<div class=menu><a href='/'>Home</a> <a href='/n'>News</a> <a href='/c'>Contact</a></div>"
FOOT = "<footer><p>© 2023 Town Gazette. All rights reserved.</p><a href='/p'>Privacy policy</a></footer>"
DIV_FOOT = "<div class=footer>© 2023 Town Gazette. All rights reserved. <a href='/p'>Privacy policy</a></div>"
TALK = "<h3>Comments (2)</h3><p>Karl says: this happens every year.</p><p>Ines says: thanks for the report!</p>"
SIDE = "<aside><h3>Related articles</h3><ul><li><a href='/1'>Bridge closed</a></li><li><a href='/2'>Rain ahead</a></li></ul></aside>"
LAYOUTS = {
    "article": f"{NAV}<article>%s</article>{FOOT}",
    "main": f"<header>{NAV}</header><main>%s</main>{SIDE}{FOOT}",
    "main_article_comments": f"{NAV}<main><article>%s</article><section id=comments>{TALK}</section></main>{FOOT}",
    "article_comments_inside": f"{NAV}<article>%s<div class=comments>{TALK}</div></article>{FOOT}",
    "content": f"{DIV_NAV}<div class=content>%s</div><div class=sidebar><a href='/1'>Bridge closed</a></div>{DIV_FOOT}",
    "post": f"{DIV_NAV}<div class='post-body'><div class=entry>%s</div></div><div id=comments>{TALK}</div>{DIV_FOOT}",
    "wrapped": f"<div class=wrapper>{NAV}<div class=story>%s</div><div class='share'><a href='#'>Tweet</a></div></div>{FOOT}",
    "table_layout": f"<table><tr><td>{DIV_NAV}</td></tr><tr><td>%s</td></tr><tr><td>{DIV_FOOT}</td></tr></table>",
    "nameless": f"<div>{DIV_NAV}</div><div>%s</div>{DIV_FOOT}",
    "cookie": f"<div class=cookie><p>We use cookies to improve your experience.</p><button>Accept all</button></div>{NAV}"
              f"<section class=story>%s</section><form><label>Search this site</label><input></form>{FOOT}",
}


def _markup(kind, x):
    if kind == "ul":
        return "<ul>" + "".join(f"<li>{i}</li>" for i in x) + "</ul>"
    if kind == "table":
        return "<table>" + "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in x) + "</table>"
    return f"<{kind}>{x}</{kind}>"


def pages(repeat=1):
    """(layout, kind, html, main blocks); `repeat` makes the articles longer."""
    for layout, around in LAYOUTS.items():
        for kind, body in BODIES.items():
            whole = body + body[1:] * (repeat - 1)
            want = [c for k, x in whole for c in (x if k == "ul" else [c for r in x for c in r] if k == "table" else [x])]
            page = "<html><head><title>Gazette</title></head><body>" + around.replace("%s", "".join(_markup(*b) for b in whole))
            yield layout, kind, page + "</body></html>", want
