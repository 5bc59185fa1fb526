"""Pages written by hand, each with its article: what the layouts' generator did not make."""

from __future__ import annotations

LONG = "The river rose in the night and by morning the lower road was under water as far as the mill."
MORE = "Nobody had seen it that high since the year the bridge went, and even then it fell within a day."
NAV = '<ul><li><a href="/">Home</a></li><li><a href="/news">News</a></li><li><a href="/about">About us</a></li></ul>'
FOOT = "<footer><p>© 2024 The Valley Herald. All rights reserved.</p></footer>"

PAGES = [
    # Of the last review: paragraphs in plain divs, and a title with paragraphs in a div without a class.
    (f"<html><body><article><h1>High water</h1><div>{LONG}</div><div>{MORE}</div></article></body></html>", ["High water", LONG, MORE]),
    (f"<html><head><title>x</title></head><body><nav>{NAV}</nav><div><h1>High water</h1><p>{LONG}</p><p>{MORE}</p></div>{FOOT}</body></html>",
     ["High water", LONG, MORE]),
    (f"<body><header><nav>{NAV}</nav></header><main><h1>Flood</h1><p>{LONG}</p><h2>After</h2><p>{MORE}</p></main>{FOOT}</body>",
     ["Flood", LONG, "After", MORE]),
    (f'<body><div class="menu">{NAV}</div><div class="content"><h1>Flood</h1><p>{LONG}</p></div><div class="sidebar"><h3>Read also</h3>{NAV}</div></body>',
     ["Flood", LONG]),
    (f'<body><div id="cookie-notice"><p>We use cookies to improve this site.</p><button>Accept</button></div><article><h1>Flood</h1><p>{LONG}</p></article></body>',
     ["Flood", LONG]),
    (f"<body><article><h1>Soup</h1><p>{LONG}</p><ul><li>two onions</li><li>one carrot</li><li>water</li></ul><p>{MORE}</p></article>{FOOT}</body>",
     ["Soup", LONG, "two onions", "one carrot", "water", MORE]),
    (f'<body><article><h1>Figures</h1><table><tr><th>Year</th><th>Level</th></tr><tr><td>1998</td><td>4.1 m</td></tr></table><p>{LONG}</p></article></body>',
     ["Figures", "Year", "Level", "1998", "4.1 m", LONG]),
    (f'<body><article><h1>Flood</h1><p>{LONG}</p><aside class="related"><h4>Related</h4>{NAV}</aside><p>{MORE}</p></article></body>',
     ["Flood", LONG, MORE]),
    (f'<body><article><h1>Flood</h1><p>{LONG}</p><div class="advert"><p>Buy rubber boots today, half price.</p></div><p>{MORE}</p></article></body>',
     ["Flood", LONG, MORE]),
    (f'<body><article><h1>Flood</h1><p>{LONG}</p></article><section id="comments"><h2>2 comments</h2><div class="comment"><p>I was there, it was awful.</p></div><div class="comment"><p>Me too.</p></div></section></body>',
     ["Flood", LONG]),
    (f"<body><article><h1>Words</h1><dl><dt>Weir</dt><dd>{LONG}</dd><dt>Sluice</dt><dd>{MORE}</dd></dl></article></body>",
     ["Words", "Weir", LONG, "Sluice", MORE]),
    (f'<body><article><h1>Flood</h1><figure><img src="a.jpg"><figcaption>The mill at noon, seen from the church.</figcaption></figure><p>{LONG}</p></article></body>',
     ["Flood", "The mill at noon, seen from the church.", LONG]),
    (f"<body><article><h1>Flood</h1><p>{LONG}</p><h4>Upstream</h4><p>{MORE}</p><h5>Downstream</h5><p>{LONG}</p></article></body>",
     ["Flood", LONG, "Upstream", MORE, "Downstream", LONG]),
    (f'<body><article><h1>Flood</h1><p>{LONG}</p><div hidden><p>{MORE}</p></div></article>{FOOT}</body>', ["Flood", LONG, MORE]),
    (f'<body><main class="page-content"><h1>Flood</h1><section><h2>Night</h2><p>{LONG}</p></section><section><h2>Day</h2><p>{MORE}</p></section></main></body>',
     ["Flood", "Night", LONG, "Day", MORE]),
    (f'<body><form class="search"><label>Search this site</label><input><button>Go</button></form><article><h1>Flood</h1><p>{LONG}</p></article></body>',
     ["Flood", LONG]),
    (f'<body><article><h1>Flood</h1><blockquote><p>{LONG}</p></blockquote><pre>level = 4.1</pre><p>{MORE}</p></article></body>',
     ["Flood", LONG, "level = 4.1", MORE]),
    (f'<body><div class="site-header"><a href="/">The Valley Herald</a></div><div class="post"><h2>Flood</h2><p>{LONG}<p>{MORE}</div><div class="footer">© 2024 Valley</div></body>',
     ["Flood", LONG, MORE]),
    (f'<body><article><h1>Fish &amp; chips</h1><p>A &lt;b&gt; is   no\n tag &mdash; <em>really</em>.</p><p>{LONG}</p></article></body>',
     ["Fish & chips", "A <b> is no tag — really.", LONG]),
    (f'<body><article><h1>Flood</h1><p>{LONG}</p></article><div class="newsletter"><p>Get our letter every week.</p><form><input><button>Sign up</button></form></div>{FOOT}</body>',
     ["Flood", LONG]),
    (f"<body><nav>{NAV}</nav><section><h1>Flood</h1><div><p>{LONG}</p></div><div><p>{MORE}</p></div></section>{FOOT}</body>",
     ["Flood", LONG, MORE]),
    (f'<body><article><h1>Flood</h1>{LONG}<br><br>{MORE}</article></body>', ["Flood", f"{LONG} {MORE}"]),
    (f"<body><nav>{NAV}</nav>{FOOT}</body>", []),
    (f'<body><article><h1>Flood</h1><p>{LONG}</p><ul class="share"><li><a href="#">Share</a></li><li><a href="#">Print</a></li></ul></article></body>',
     ["Flood", LONG]),
]
