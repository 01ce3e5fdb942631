"""Pages written by hand in layouts the training generator does not make, and their articles' blocks."""

A = "The river rose by two metres overnight, and the old bridge was closed to all traffic before dawn."
B = "Residents were asked to leave their homes. Most of them went to the school on the hill, where beds had been set up."
C = "\"We have not seen this since 1987,\" said the mayor, who spent the night at the station. \"It could have been worse.\""
D = "By noon the water had begun to fall, and engineers expected to open one lane by the end of the week."
H = "Bridge closed after flood"
P4 = f"<p>{A}</p><p>{B}</p><p>{C}</p><p>{D}</p>"
NAV = '<ul><li><a href="/">Home</a></li><li><a href="/news">News</a></li><li><a href="/sport">Sport</a></li><li><a href="/mail">Mail</a></li></ul>'
FOOT = '<div id="footer">&copy; 2024 The Valley Post. <a href="/terms">Terms</a> <a href="/privacy">Privacy</a></div>'

PAGES = [
    (f"<body><p>{A}</p></body>", [A]),
    (A, [A]),
    (f"{A}<br>{B}", [f"{A} {B}"]),
    (f"<html><body><h1>{H}</h1>{P4}</body></html>", [H, A, B, C, D]),
    (f"<html><head><title>x</title></head><body>{NAV}<h1>{H}</h1>{P4}{FOOT}</body></html>", [H, A, B, C, D]),
    (f"<body><div><div><p>{A} {B} {C} {D} {A} {B}</p></div></div></body>", [f"{A} {B} {C} {D} {A} {B}"]),
    (f'<body><div class="css-9f3x"><h1>{H}</h1>{P4}</div></body>', [H, A, B, C, D]),
    (f'<body><article class="post tag-news category-ads"><p>{A}</p><p>{B}</p></article></body>', [A, B]),
    (f'<body><article class="post category-food"><p>{A}</p><p>{B}</p></article>{FOOT}</body>', [A, B]),
    (f"<body><table><tr><td>{NAV}</td><td><h1>{H}</h1>{P4}</td></tr></table></body>", [H, A, B, C, D]),
    (f'<body><div id="nav">{NAV}</div><div id="main"><h2>{H}</h2>{P4}</div>{FOOT}</body>', [H, A, B, C, D]),
    (f"<body><main><h1>{H}</h1><p>{A}</p><aside class=pullquote><p>{C}</p></aside><p>{B}</p></main></body>", [H, A, C, B]),
    (f"<body><article><h1>{H}</h1><p>{A}</p><aside class=pullquote>{C}</aside><p>{D}</p></article></body>", [H, A, C, D]),
    (f"<body><header><a href=/>The Valley Post</a></header><article><h1>{H}</h1>{P4}</article><footer>&copy; The Valley Post</footer></body>", [H, A, B, C, D]),
    (f"<body><section><h1>{H}</h1>{P4}</section><section class=comments><h3>3 comments</h3><p>I live there, it was bad.</p><p>Stay safe!</p></section></body>", [H, A, B, C, D]),
    (f'<body><div class="wrap"><div class="left">{NAV}</div><div class="right"><h1>{H}</h1>{P4}</div></div></body>', [H, A, B, C, D]),
    (f"<body><h1>{H}</h1>{P4}<div class=ad>Buy boots now, 50% off at Boots and More</div></body>", [H, A, B, C, D]),
    (f'<body><div class="cookie-notice"><p>We use cookies to improve this site.</p><button>OK</button></div><h1>{H}</h1>{P4}</body>', [H, A, B, C, D]),
    (f"<body><center><h1>{H}</h1>{P4}</center></body>", [H, A, B, C, D]),
    (f"<body><div><h1>{H}</h1><div>{A}</div><div>{B}</div><div>{C}</div></div></body>", [H, A, B, C]),
    (f"<body><div role=main><h1>{H}</h1>{P4}<ul><li>Road 7 is closed</li><li>Road 9 is open</li></ul></div></body>", [H, A, B, C, D, "Road 7 is closed", "Road 9 is open"]),
    (f"<body><article><h1>{H}</h1><p>{A}</p><table><tr><td>Monday</td><td>2.1 m</td></tr><tr><td>Tuesday</td><td>1.4 m</td></tr></table><p>{B}</p></article></body>", [H, A, "Monday", "2.1 m", "Tuesday", "1.4 m", B]),
    (f"<body><div class=story><p>{A}</p><p>{B}</p></div><div class=related><h3>More</h3><ul><li><a href=/a>Storm warning lifted</a></li><li><a href=/b>Ten photos</a></li></ul></div></body>", [A, B]),
    (f"<body><blockquote>{C}</blockquote><p>{A}</p><p>{B}</p></body>", [C, A, B]),
    (f"<body><div><div><div><h1>{H}</h1>{P4}</div></div></div>{FOOT}</body>", [H, A, B, C, D]),
    (f'<body><div class="content no-sidebar"><h1>{H}</h1>{P4}</div></body>', [H, A, B, C, D]),
    (f'<body class="home page"><div class="entry-content social-share-on"><p>{A}</p><p>{B}</p><p>{D}</p></div></body>', [A, B, D]),
    (f"<h1>{H}</h1>{P4}", [H, A, B, C, D]),
    (f"<p>{A}<p>{B}<p>{C}", [A, B, C]),
    (f"<body><form action=/s><label>Search</label><input name=q><button>Go</button></form><h1>{H}</h1>{P4}</body>", [H, A, B, C, D]),
    (f"<body><div id=page><div id=head><a href=/>Valley Post</a></div><div id=text><h1>{H}</h1>{P4}</div><div id=foot>&copy; 2024 Valley Post</div></div></body>", [H, A, B, C, D]),
    (f"<body><article><h1>{H}</h1><figure><img src=a.jpg><figcaption>The bridge on Monday.</figcaption></figure>{P4}</article></body>", [H, "The bridge on Monday.", A, B, C, D]),
    (f"<body><dl><dt>{H}</dt><dd>{A}</dd><dd>{B}</dd></dl></body>", [H, A, B]),
    (f"<body><pre>{A}\n{B}</pre></body>", [f"{A} {B}"]),
]
