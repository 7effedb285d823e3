"""Extraction on pages written and labelled by hand, in shapes that the training pages don't come in."""

from layoutspark.llm import html_extract

#: (name, html); the main text is what stands in [[ and ]].
HAND_LABELLED = [
    ("news", """<!doctype html><html lang=en><head><meta charset=utf-8><title>Bridge reopens | The Daily</title><script>window.x=1</script></head><body class="page-news has-rail">
<div id="skip"><a href="#c">Skip to content</a></div><header class="c-masthead"><div class="c-logo"><a href="/">The Daily</a></div><ul class="c-nav"><li><a href=/uk>UK</a><li><a href=/world>World</a><li><a href=/sport>Sport</a></ul></header>
<main id="c"><article class="story"><h1>[[Old bridge reopens after three years of repairs]]</h1><div class="story__text"><p>[[The old bridge over the river reopened on Monday, three years after a lorry struck its northern pier.]]</p><p>[[Engineers replaced 240 stones, said the council's <a href=/x>head of works</a>, and the arch was raised by two centimetres.]]</p>
<aside class="promo-box"><h2>Read more</h2><a href=/a>Ten bridges to cross before you retire</a></aside><p>[["We never doubted that it would hold," she said.]]</p><blockquote>[[It is the third repair in a century.]]</blockquote><p>[[Traffic is limited to one lane until May.]]</p></div></article></main>
<aside class="rail"><h3>Most read</h3><ol><li><a href=/1>Storm closes harbour</a><li><a href=/2>Bakery wins prize</a></ol></aside><footer class="c-foot"><ul><li><a href=/t>Terms</a><li><a href=/p>Privacy</a></ul><p>© 2024 The Daily. All rights reserved.</p></footer></body></html>"""),
    ("blog", """<html><body><div id="wrapper"><div id="header"><h2><a href="/">Notes from a small garden</a></h2><p>mostly tomatoes</p></div><div id="nav"><a href="/">Home</a> | <a href="/about">About</a> | <a href="/feed">Feed</a></div>
<div id="content"><div class="post"><h2>[[How I saved the seedlings]]</h2><p>[[In April the nights went down to two degrees and I had forty seedlings on the balcony.]]</p><p>[[So I did what my grandmother did:]]</p><ul><li>[[filled bottles with warm water,]]</li><li>[[set them between the pots,]]</li><li>[[and covered it all with an old curtain.]]</li></ul><p>[[All but three survived.]]</p></div>
<div id="comments"><h3>2 responses</h3><div class="comment"><p>Lovely idea, I will try this with my peppers next week.</p></div><div class="comment"><p>My curtain is too short, sadly.</p></div></div><div id="respond"><form><label>Name</label><input><textarea></textarea><button>Post comment</button></form></div></div>
<div id="sidebar"><h3>Archive</h3><ul><li><a href=/3>March</a></li><li><a href=/2>February</a></li></ul></div><div id="footer">Powered by a potato. Theme by nobody.</div></div></body></html>"""),
    ("manual", """<html><body><nav role=navigation aria-label=main><ul><li><a href=1>Guide</a></li><li><a href=2>Reference</a></li></ul></nav><div class="toc"><p>On this page</p><ul><li><a href=#a>Install</a></li><li><a href=#b>Use</a></li></ul></div>
<main><h1>[[Getting started]]</h1><section id=a><h2>[[Install]]</h2><p>[[Unpack the archive and run the program once.]]</p><pre>[[./setup --all]]</pre><p>[[The first run takes a minute.]]</p></section><section id=b><h2>[[Use]]</h2><table><tr><th>[[Option]]</th><th>[[Meaning]]</th></tr><tr><td>[[-v]]</td><td>[[prints what it does]]</td></tr></table><p>[[Options may be combined.]]</p></section></main>
<div class="pagination"><a href=0>Previous</a> <a href=2>Next</a></div><footer><p>Last built on 3 May. <a href=s>View source</a></p></footer></body></html>"""),
    ("recipe", """<html><body><div class="cookie-bar"><p>We use cookies to remember your oven. <a href=/c>More</a></p><button>Fine</button></div><div class="site-header"><a href="/">Kitchen</a></div>
<div class="entry-content"><h1>[[Lentil soup]]</h1><p>[[A soup for cold evenings, ready in half an hour.]]</p><h3>[[You need]]</h3><ul><li>[[200 g red lentils]]</li><li>[[one onion]]</li><li>[[a litre of stock]]</li></ul><div class="ad-slot"><p>Knives at half price, this week only!</p></div><h3>[[Method]]</h3><ol><li>[[Fry the onion until it is soft.]]</li><li>[[Add lentils and stock and boil for twenty minutes.]]</li></ol></div>
<div class="related-posts"><h3>You may also like</h3><ul><li><a href=1>Bean stew</a></li><li><a href=2>Pea soup</a></li></ul></div><div class="newsletter-signup"><form><p>A recipe a week in your inbox.</p><input type=email><button>Subscribe</button></form></div><div class="site-footer"><p>Kitchen is a hobby of two people.</p></div></body></html>"""),
    ("plain", """<html><body><h1>[[On rivers]]</h1><p>[[A river is never the same twice, as has been said too often.]]<p>[[But its bed is, or nearly so, and the maps depend on it.]]<p>[[That is all.]]<hr><address>Written by hand, 1998</address></body></html>"""),
    ("university", """<html><body><div class="banner"><a href=/><img src=l></a><span>Faculty of Letters</span></div><div class="breadcrumbs"><a href=/>Home</a> &raquo; <a href=/news>News</a></div><div role="main" class="node"><h2>[[New chair for dialectology]]</h2><div class="field-body"><p>[[The faculty has appointed a new chair, who will begin in autumn.]]</p><p>[[She has studied the dialects of the northern valleys for twenty years.]]</p><figure><img src=x><figcaption>[[The new chair in the library.]]</figcaption></figure></div></div>
<div class="block-menu"><ul class="menu"><li><a href=s>Students</a></li><li><a href=r>Research</a></li></ul></div><div id="footer-wrapper"><p>Contact: letters@example.org</p></div></body></html>"""),
]


def measured():
    chain, wrong, total = html_extract.default_chain(), [], 0
    for name, page in HAND_LABELLED:
        main = {" ".join(b.text.replace("[[", "").replace("]]", "").split()) for b in html_extract.leaf_blocks(page) if "[[" in b.text}
        blocks = html_extract.leaf_blocks(page.replace("[[", "").replace("]]", ""))
        for b, keep in zip(blocks, chain.decode(blocks)):
            total += 1
            if keep != (b.text in main):
                wrong.append((name, keep, b.text))
    return wrong, total


def test_extraction_on_pages_labelled_by_hand():
    wrong, total = measured()
    assert total > 80 and len(wrong) / total < 0.06, wrong
