"""The labelled blocks that the classifier of ``html_text`` learns from: pages laid out by hand.

``data-main`` marks the elements whose blocks are main text, and ``{n}`` stands for n words of filler. The
pages cover the common layouts: with and without elements that say what they are, in lists, tables and plain
divisions, with short and long paragraphs, and with what usually surrounds a text.
"""

from __future__ import annotations

import re

WORDS = "lorem ipsum dolor sit amet consetetur sadipscing elitr sed diam nonumy eirmod".split()

LAYOUTS = (
    """<body><nav><ul><li><a href=/>{1}</a></li><li><a href=/b>{1}</a></li><li><a href=/c>{2}</a></li></ul></nav>
    <div class="ad">{9}</div><article data-main><h1>{8}</h1><p>{40}</p><p>{1}</p><p>{2}</p><p>{75}</p><p>{6}</p>
    <p>{1}</p><p>{22}</p></article><footer>&copy; {2} &middot; {9}</footer></body>""",
    """<body><header><a href=/>{2}</a><p>{5}</p></header><nav><a href=/>{1}</a> <a href=/x>{1}</a></nav><main>
    <article><header data-main><h1>{5}</h1><p>{3}</p></header><p data-main>{30}</p><p data-main>{3}</p>
    <ul data-main><li>{6}</li><li>{2}</li><li><a href=/y>{3}</a></li></ul><div class="advert">{12}</div>
    <p data-main>{55}</p><blockquote data-main>{14}</blockquote><footer>{3} <a href=/t>{1}</a></footer></article>
    <aside><h2>{2}</h2><p>{25}</p><ul><li><a href=/r>{6}</a></li><li><a href=/s>{7}</a></li></ul></aside></main>
    <section id="comments"><h3>{2}</h3><div class="comment"><p>{35}</p></div><div class="comment"><p>{4}</p></div>
    </section><footer><p>{10}</p></footer></body>""",
    """<body><div id="menu"><a href=/>{1}</a><a href=/a>{1}</a><a href=/b>{1}</a></div><div id="cookie-notice">{24}
    <button>{1}</button></div><div id="content"><h1 data-main>{6}</h1><p data-main>{48}</p><p data-main>{9}</p>
    <p data-main>{33}</p><p data-main>{60} <a href=/q>{2}</a> {12}</p></div><div id="sidebar"><p>{18}</p><p>{30}</p>
    </div><form><label>{2}</label><p>{8}</p></form><div id="footer">{8}</div></body>""",
    """<body><table><tr><td><a href=/>{1}</a></td><td><a href=/a>{1}</a></td><td><a href=/b>{2}</a></td></tr></table>
    <table><tr><td data-main>{80}</td></tr><tr><td data-main>{45}</td></tr><tr><td data-main>{28}</td></tr></table>
    <table><tr><td><a href=/n>{3}</a> | <a href=/m>{2}</a></td><td>{4}</td></tr></table></body>""",
    """<body><div><a href=/>{1}</a></div><div><a href=/a>{1}</a></div><div><a href=/b>{1}</a></div><div>{3}</div>
    <div><div data-main><p>{35}</p><p>{50}</p><p>{8}</p><p>{41}</p><p>{12}</p><p>{64}</p></div></div>
    <div><a href=/c>{3}</a></div><div><a href=/d>{4}</a></div><div>{5}</div></body>""",
    """<body><div class="topbar">{6} <a href=/>{1}</a></div><main data-main><h1>{4}</h1><h2>{3}</h2><p>{4}</p><p>{1}</p>
    <h2>{2}</h2><p>{2}</p><pre>{15}</pre></main><div class="newsletter"><h3>{3}</h3><p>{16}</p></div>
    <div class="related-posts"><h3>{2}</h3><p>{20}</p><p><a href=/z>{8}</a></p></div></body>""",
    """<body><nav>{2}</nav><article data-main><p>{1}</p></article><footer>{12}</footer></body>""",
    """<body><nav><a href=/>{1}</a></nav><div role="alert">{15}</div><article data-main><h1>{3}</h1><p>{2}</p></article>
    <div class="comments"><p>{60}</p><p>{2}</p></div><div role="contentinfo">{6}</div></body>""",
    """<body><div role="banner">{4}</div><div role="navigation"><a href=/>{1}</a></div><div role="main" data-main>
    <h1>{7}</h1><p>{26}</p><p><a href=/o>{2}</a></p><p>{37}</p><table><tr><td>{1}</td><td>{3}</td></tr></table></div>
    <div role="complementary"><p>{28}</p></div></body>""",
    """<body><div class="site-header"><p>{3}</p></div><div class="post" data-main><p>{44}</p><p>{25}</p><p>{31}</p>
    <p>{18}</p><p>{52}</p></div><div class="share"><a href=/f>{1}</a> {2}</div><div class="pagination">{3}
    <a href=/2>{1}</a></div><div>{4} <a href=/i>{1}</a> <a href=/j>{1}</a></div></body>""",
    """<body><p><a href=/>{2}</a></p><p><a href=/a>{1}</a> <a href=/b>{1}</a> <a href=/c>{1}</a></p><h1 data-main>{6}</h1>
    <p data-main>{70}</p><p data-main>{15}</p><p data-main>{39}</p><p><a href=/l>{5}</a></p><p><a href=/k>{6}</a></p>
    <p>{4}</p></body>""",
    """<body><aside><p>{80}</p><p>{44}</p></aside><article data-main><h1>{2}</h1><p>{90}</p><p>{3}</p><p>{11}</p></article>
    <aside><p>{5}</p></aside><section class="user-comments"><article><p>{40}</p></article><article><p>{1}</p></article>
    </section><div class="sponsored"><p>{33}</p></div></body>""",
    """<body><ul><li><a href=/>{1}</a></li><li><a href=/a>{1}</a></li></ul><div data-main>{120}<br>{30}</div>
    <div data-main>{65}</div><ul><li><a href=/p>{4}</a></li><li><a href=/q>{5}</a></li></ul><div>{2}</div></body>""",
    """<body><form><p>{14}</p><p>{2}</p></form><dialog><p>{20}</p></dialog><article data-main><p>{12}</p><p>{1}</p>
    <p>{1}</p><p>{19}</p></article><div class="popup"><p>{31}</p></div><footer><p>{45}</p><a href=/>{1}</a></footer>
    </body>""",
    """<article data-main><h1>{5}</h1><p>{30}</p><p>{2}</p><ul><li>{4}</li><li><a href=/u>{2}</a></li></ul></article>""",
    """<body><nav><a href=/>{1}</a></nav><article data-main><h1>{3}</h1><p>{21}</p><p><a href=/v>{3}</a></p><p>{1}""",
    """<p data-main>{12}</p><p data-main>{1}</p><p data-main>{40}</p><p data-main>{3}</p><p data-main>{28}</p>""",
    """<p data-main>{3}</p>""",
    """<body><nav>{3}</nav><article data-main><h1>{6}</h1><p>{41}</p><p>{5}</p></article></body>""",
    """<body><nav>{1}</nav><article data-main><p>{20}</p><p>{1}</p><p>{13}</p></article>""",
    """<body><nav><a href=/>{5}</a></nav><article data-main><p>{30}</p><p><a href=/c>{6}</a></p><p>{12}</p><p>
    <a href=/d>{9}</a></p><p>{3}</p><h2><a href=/e>{7}</a></h2><p>{44}</p></article><div><a href=/f>{6}</a></div>
    <div>{19}</div><div>{3}</div></body>""",
    """<body><div><a href=/>{8}</a></div><p>{14}</p><main data-main><p>{2}</p><p><a href=/g>{5}</a> {1}</p><p>{9}</p>
    </main><p><a href=/h>{7}</a></p><p>{32}</p></body>""",
    """<body><div class="advert">{7}</div><main data-main><p>{8}</p><p>{52}</p></main>""",
    """<body><p data-main>{18}</p><p data-main>{36}</p><p data-main>{23}</p></body>""",
    """<body data-main>{60}""",
    """<body><div>{4}</div><p>{22}</p><article data-main><p>{1}</p><p>{17}</p><p>{2}</p></article><div><p>{26}</p>
    <p>{3}</p></div><p>{38}</p></body>""",
    """<body><p>{9}</p><div>{2}</div><main data-main><p>{33}</p><p>{4}</p><p><a href=/w>{1}</a></p></main><div>{12}</div>
    <div>{41}</div><p>{1}</p></body>""",
    """<body><h1 data-main>{4}</h1><p data-main>{7}</p><p data-main>{35}</p><p data-main>{2}</p><div class="tags-menu">
    <a href=/1>{1}</a></div></body>""",
    """<body><ul><li><a href=/>{2}</a></li><li><a href=/a>{1}</a></li></ul><h2 data-main>{3}</h2><p data-main>{24}</p>
    <ul data-main><li>{5}</li><li>{9}</li><li>{2}</li></ul><p data-main>{47}</p></body>""",
)


#: Each layout is learnt from with blocks of so many times its lengths.
LENGTHS = (1.0, 0.2, 2.5)


def filled(layout: str, times: float = 1.0) -> str:
    """The page with words of filler for each ``{n}``, one at least."""

    def words(found: re.Match) -> str:
        n = max(1, round(times * int(found.group(1))))
        return " ".join(WORDS[i % len(WORDS)] for i in range(n))

    return re.sub(r"\{(\d+)\}", words, layout)


def pages() -> list[str]:
    return [filled(layout, times) for times in LENGTHS for layout in LAYOUTS]
