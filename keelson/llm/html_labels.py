"""Labelled pages: what stands between ``[[`` and ``]]`` is main text (a page
may have several such stretches).

They are written by hand for the usual layouts (with and without semantic
elements, link lists, boxes around and inside the article) and are all that
the token weights of ``html_extract`` are counted from.
"""

WORDS = ("Rivers carry sand and silt to the coast, where the tide spreads them over wide flats. "
         "Birds feed there in winter and rest on the higher banks when the water rises.")
SHORT = "The harbour was closed for a week."
LINKS = "".join(f'<li><a href="/{x}">{x}</a></li>' for x in
                ("home", "news", "weather", "sport", "culture", "travel", "contact us"))

PAGES = (
    f"<html><head><title>Tides</title></head><body><nav><ul>{LINKS}</ul></nav>"
    f"<div>Latest updates from our partners</div><article>[[<h1>Tides</h1><p>{WORDS}</p>"
    f"<p>{SHORT}</p><ul><li>sand</li><li>silt</li></ul><p>{WORDS}</p>]]</article>"
    f"<div>More from this section <a href='/a'>Storms</a> <a href='/b'>Dunes</a></div>"
    f"<p>All rights reserved by the publisher.</p></body></html>",
    f"<html><body><div><a href='/'>Start</a> <a href='/in'>Sign in</a></div><main>[[<h1>Harbours"
    f"</h1><h2>Old walls</h2><p>{WORDS}</p><blockquote>{SHORT}</blockquote><p>{SHORT}<br>{WORDS}"
    f"</p>]]</main><div><p>Read our terms and privacy pages.</p><ul>{LINKS}</ul></div></body></html>",
    f"<html><body><ul>{LINKS}</ul><div>[[<h1>Salt marshes</h1><p>{WORDS} <a href='/x'>Maps</a> "
    f"show them.</p><p>{WORDS}</p><h2>Winter</h2><p>{SHORT}</p><p>{WORDS}</p>]]</div><div>"
    f"<ul>{LINKS}</ul></div><div><a href='/t'>Terms</a> <a href='/p'>Privacy</a></div></body></html>",
    f"<html><body><table><tr><td><a href='/1'>One</a></td><td><a href='/2'>Two</a></td></tr></table>"
    f"<div>[[<p>{WORDS}</p><table><tr><td>depth</td><td>four metres</td></tr></table>"
    f"<p>{WORDS}</p><p>{WORDS}</p>]]</div><ul>{LINKS}</ul><div><a href='/u'>Up</a></div></body></html>",
    f"<html><body><div><span>Menu</span><ul>{LINKS}</ul></div><section>[[<h2>Storms</h2><p>{SHORT}</p>"
    f"<ol><li>{SHORT}</li><li>{WORDS}</li></ol><p>{WORDS}</p><pre>{SHORT}</pre>]]</section>"
    f"<div><h3>See too</h3><ul>{LINKS}</ul></div></body></html>",
    f"<html><body><article>[[<h1>Dunes</h1><p>{SHORT}</p>]]</article><div>Weather today is mild "
    f"with a light wind from the west</div><p>Subscribe for the weekly letter.</p>"
    f"<ul>{LINKS}</ul></body></html>",
    f"<html><body><div><a href='/'>Start</a> | <a href='/all'>All</a></div><div>[[{WORDS}<br><br>"
    f"{WORDS}<br>{SHORT}<br>{WORDS}]]</div><div>Top | Print | Send</div></body></html>",
    f"[[{WORDS}\n\n{WORDS}]]",
    # boxes by element: never main text, around the article and inside it
    f"<html><body><header><a href='/'>The Tidal Times</a><p>{SHORT}</p></header><article>[[<h1>Locks"
    f"</h1><p>{WORDS}</p>]]<aside><h2>In short</h2><p>{SHORT}</p></aside>[[<p>{WORDS}</p>]]<form><p>"
    f"{SHORT}</p><label>Name</label><button>Send</button></form></article><aside><p>{WORDS}</p><ul>"
    f"{LINKS}</ul></aside><footer><p>{SHORT}</p>Imprint and terms <a href='/i'>Imprint</a></footer>"
    f"</body></html>",
    f"<html><body><nav>Start <a href='/'>Home</a><p>{SHORT}</p></nav><div>[[<p>{WORDS}</p><p>{SHORT}"
    f"</p>]]</div><div hidden><p>{WORDS}</p>{SHORT}<ul><li>{SHORT}</li></ul></div><footer><table><tr>"
    f"<td>{SHORT}</td></tr></table><h3>About us</h3></footer></body></html>",
    # boxes whose class or id says so and nothing else
    f"<html><body><div class='banner'><p>{SHORT}</p></div><article>[[<h1>Mills</h1><p>{WORDS}</p>]]"
    f"<div class='ad'><p>{SHORT}</p>Buy now <a href='/b'>here</a></div>[[<p>{WORDS}</p><p>{SHORT}</p>"
    f"]]<div class='share-bar'><a href='/s'>Share</a> Send</div></article><div id='comments'><h3>Two "
    f"replies</h3><p>{WORDS}</p><ul><li>{SHORT}</li><li>{WORDS}</li></ul></div></body></html>",
    f"<html><body><div id='pageMenu'><ul>{LINKS}</ul></div><div id='text'>[[<h1>Ferries</h1><p>{WORDS}"
    f"</p><p>{WORDS}</p>]]<div class='related-posts'><h4>Related</h4><p>{SHORT}</p><ul>{LINKS}</ul>"
    f"</div></div><div class='sidebar'><p>{WORDS}</p>{WORDS}<table><tr><td>{SHORT}</td></tr></table>"
    f"</div><div class='commentlist'><p>{WORDS}</p><a href='/r'>Reply to this</a></div></body></html>",
    f"<html><body><div class='cookie-notice'>{SHORT} <a href='/c'>Accept</a></div><section>[[<p>{WORDS}"
    f"</p><p>{WORDS}</p>]]</section><div class='newsletter'><h3>Letters</h3><p>{SHORT}</p></div>"
    f"<div id='siteFooter'><p>{SHORT}</p><ul>{LINKS}</ul></div></body></html>",
    # boxes whose class or id says so among other things: prose, or not
    f"<html><body><article>[[<h1>Signals</h1><p>{WORDS}</p><section class='alert-history'><h2>Old"
    f" alarms</h2><p>{WORDS}</p><p>{SHORT}</p><p>{WORDS}</p></section><p>{WORDS}</p>]]<div class="
    f"'tags-share-tools'><a href='/t'>Tides</a> <a href='/u'>Coast</a> Print</div></article></body></html>",
    f"<html><body><div class='promo-tides'><ul>{LINKS}</ul><h4>Offers</h4>Order today</div><div>[[<p>"
    f"{WORDS}</p><div class='search-for-salt'><p>{WORDS}</p><p>{WORDS}</p></div><p>{SHORT}</p>]]</div>"
    f"<div class='social-icons-row'><a href='/f'>Follow us</a><ul>{LINKS}</ul></div></body></html>",
    f"<html><body><main>[[<h1>Pilots</h1><div class='article-search-body'><p>{WORDS}</p><p>{WORDS}</p>"
    f"</div><p>{SHORT}</p>]]<div class='widget-weather-now'>Mild <b>12</b> <a href='/w'>More</a>"
    f"<h3>Weather</h3></div></main></body></html>",
    # prose around tables, quotes and definition lists
    f"<html><body><main>[[<h1>Tolls</h1><dl><dt>Boat</dt><dd>{SHORT}</dd></dl><table><tr><th>Year</th>"
    f"<th>Ships</th></tr><tr><td>{SHORT}</td><td>40</td></tr></table><p>{WORDS}</p><blockquote><p>"
    f"{SHORT}</p></blockquote><ul><li><a href='/m'>{SHORT}</a></li><li>{WORDS}</li></ul>]]</main>"
    f"<div>Printed on <a href='/p'>paper</a></div></body></html>",
    f"<html><body><center><a href='/'>Up</a></center>[[<h2>Buoys</h2>{WORDS}<p>{WORDS}<p>{SHORT}"
    f"<p>{WORDS}]]<hr><a href='/n'>Next</a> <a href='/v'>Back</a></body></html>",
)
