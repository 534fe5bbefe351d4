"""Small editions with all that is due of them: lines, and for each form what the rules of the markup make of these.

§k, §n and §w stand for a row's number, its page and a word. Each form was made by the fold and read against the rules of the markup before it was set down here.
"""

LINES = {
    0: '{Part §w}\n<§n>\n[§n,1]\nalpha §w\ngam-\nma ≤x≥«y» end <99> far\n<side note>\n[§n,5]\nmore ≤z≥ «q» ¿r¿ & so',
    1: '{Act §w}\n((all enter\nslowly)) now\n[1,1]\n\nann — ((bows)) hello §w\n[1,2]\n\nbob — ˹foo ((aside)) bar˼ baz\n[1,3]\n\ncid —\n\tkim §k |\n\t˹ta || 1 ||˼\n\ndan —\t\titi |\n\t\tca || 2 ||',
    2: '{Verses}\n[§n,1]\nas is said |_\n\taaa §w\n\tccc |\n\teee || §k || thus |\n_iti\n\tggg || 2 ||\nprose after\n[1.1ab]\tlorem §w |\n[1.1cd]\tipsum <7> dolor ||',
}
XML = {
    0: '<body><div n="Part §w"><pb n="§n"/><p xml:id="p§n_l1" n="§n,1">alpha §w <lb n="2"/> gam<lb n="3" break="no"/>ma <choice><sic>x</sic><corr>y</corr></choice> end <pb n="99"/> far <lb n="2"/><milestone n="side note"/></p><p xml:id="p§n_l5" n="§n,5">more <del>z</del> <supplied>q</supplied> <unclear>r</unclear> &amp; so <lb n="6"/></p></div></body>',
    1: '<body><div n="Act §w"><p><stage>all enter\nslowly</stage> </p><p>now </p><sp who="ann"><speaker>ann</speaker><p n="1,1" xml:id="p1_l1"><stage>bows</stage> hello §w </p></sp><sp who="bob"><speaker>bob</speaker><p n="1,2" xml:id="p1_l2"><seg type="prakrit" xml:lang="pra-Latn">foo <stage>aside</stage> bar<seg type="chāyā" xml:lang="san-Latn">gloss §k</seg></seg> baz </p></sp><sp who="cid"><speaker>cid</speaker><lg xml:id="p1_l3" n="1,3"><l><lb n="4"/>kim §k |</l><l xml:lang="pra-Latn">ta || 1 ||</l><lg type="chāyā" xml:lang="san-Latn"><l>one</l><l>two</l></lg></lg></sp><sp who="dan"><speaker>dan</speaker><lg xml:id="p1_l3_2" n="1,3"><l rend="indent(2)">iti |</l><l rend="indent(2)">ca || 2 ||</l></lg></sp></div></body>',
    2: '<body><div n="Verses"><lg type="group" n="§n,1" xml:id="p§n_l1"><lg><head>as is said |</head><l>aaa §w<caesura/>ccc |</l><l>eee || §k ||  iti</l><back>thus |</back></lg><lg><l>ggg || 2 ||</l></lg></lg><p>prose after </p><lg n="1.1" xml:id="v1_1"><l n="ab">lorem §w |</l><l n="cd">ipsum <pb n="7"/> dolor ||</l></lg></div></body>',
}
READING = {
    0: 'alpha §w  gamma y end  far\nmore qr & so\n',
    1: '(all enter\nslowly)\nnow\n(bows)  hello §w\nfoo (aside) bar (gloss §k) baz\nkim §k |\nta || 1 ||\none\ntwo\niti |\nca || 2 ||\n',
    2: 'as is said |\naaa §wccc |\neee || §k ||  iti\nthus |\nggg || 2 ||\nprose after\nlorem §w |\nipsum  dolor ||\n',
}
MARKUP = {
    0: '{Part §w}\n\n<§n>\n\n[§n,1]\nalpha §w\ngam-\nma ≤x≥«y» end\n<99>\nfar\nside note\n\n[§n,5]\nmore ≤z≥ «q» ¿r¿ & so\n',
    1: '{Act §w}\n\n((all enter slowly))\nnow\nann —\n\n[1,1]\n((bows)) hello §w\nbob —\n\n[1,2]\n˹foo ((aside)) bar˼ baz\ncid —\n\n[1,3]\n \tkim §k |\n\tta || 1 ||\ndan —\n\n[1,3]\n\t\titi |\n\t\tca || 2 ||\n',
    2: '{Verses}\n[§n,1]\nas is said |\t\taaa §w\tccc |\n\teee || §k ||  itithus |\n\tggg || 2 ||\nprose after\n[1.1ab]\tlorem §w |\n[1.1cd]\tipsum  <7>  dolor ||\n',
}
PLAIN = {
    0: '<html><head><meta charset="utf-8"/><title>§k</title><meta name="viewport" content="width=device-width, initial-scale=1.0"/></head><body><div id="content"><h1 id="Part_§w">§ Part §w</h1><h3 class="editorial-coord rich-text" id="§n_1">p.§n, l.1</h3><p class="plain-text">alpha §w  gamma y end  far </p><h3 class="editorial-coord rich-text" id="§n_5">p.§n, l.5</h3><p class="plain-text">more qr &amp; so </p></div></body></html>',
    1: '<html><head><meta charset="utf-8"/><title>§k</title><meta name="viewport" content="width=device-width, initial-scale=1.0"/></head><body><div id="content"><h1 id="Act_§w">§ Act §w</h1><p class="plain-text">(all enter\nslowly) </p><p class="plain-text">now </p><h3 class="editorial-coord rich-text" id="1_1">p.1, l.1</h3><div class="speech plain-text"><p>ann — (bows)  hello §w </p></div><h3 class="editorial-coord rich-text" id="1_2">p.1, l.2</h3><div class="speech plain-text"><p>bob — foo (aside) bar (gloss §k) baz </p></div><h3 class="editorial-coord rich-text" id="1_3">p.1, l.3</h3><div class="speech plain-text"><p>cid — </p><div class="lg plain-text"><span>kim §k |</span><span>ta || 1 ||</span><div class="chaya"><span>one</span><span>two</span></div></div></div><div class="speech plain-text"><p>dan — </p><div class="lg plain-text"><span>iti |</span><span>ca || 2 ||</span></div></div></div></body></html>',
    2: '<html><head><meta charset="utf-8"/><title>§k</title><meta name="viewport" content="width=device-width, initial-scale=1.0"/></head><body><div id="content"><h1 id="Verses">§ Verses</h1><h3 class="editorial-coord rich-text" id="§n_1">p.§n, l.1</h3><div class="lg plain-text"><p class="lg-head">as is said |</p><span>aaa §w</span><span>ccc |</span><span>eee || §k ||  itithus |</span></div><div class="lg plain-text"><span>ggg || 2 ||</span></div><p class="plain-text">prose after </p><div class="lg plain-text"><span>lorem §w |</span><span>ipsum  dolor ||</span></div></div></body></html>',
}
HTML = {
    0: '<div id="content" class="hide-editorial-coords"><h1 id="Part_§w">§ Part §w</h1><h3 class="editorial-coord rich-text" id="§n_1">p.§n, l.1</h3><p class="rich-text"><a class="pb-label rich-text" data-page="§n" target="_blank">(p.§n, l.1)</a>alpha §w <br class="lb-br rich-text"/><span class="lb-label rich-text" data-line="2">(p.§n, l.2)</span>gam<span class="hyphen">-</span><br class="lb-br rich-text"/><span class="lb-label rich-text" data-line="3">(p.§n, l.3)</span>ma <span class="correction"><i class="ante-correction" title="pre-correction (post-: y)">x</i><i class="post-correction" style="display:none;" title="post-correction (pre-: x)">y</i></span> end <br class="lb-br rich-text"/><a class="pb-label rich-text" data-page="99" target="_blank">(p.99, l.1)</a>far </p><p class="plain-text">alpha §w  gamma y end  far </p><h3 class="editorial-coord rich-text" id="§n_5">p.§n, l.5</h3><p class="rich-text"><span class="lb-label rich-text" data-line="5">(p.§n, l.5)</span>more <span class="correction"><i class="ante-correction" title="deletion">z</i><i class="post-correction" style="display:none;"/></span> <span class="correction"><i class="ante-correction"/><i class="post-correction" style="display:none;" title="supplied">q</i></span> <span class="unclear" title="unclear">r</span> &amp; so </p><p class="plain-text">more qr &amp; so </p></div>',
    1: '<div id="content" class="hide-editorial-coords"><h1 id="Act_§w">§ Act §w</h1><p class="rich-text"><span class="stage-direction">(all enter\nslowly)</span> </p><p class="plain-text">(all enter\nslowly) </p><p class="rich-text">now </p><p class="plain-text">now </p><h3 class="editorial-coord rich-text" id="1_1">p.1, l.1</h3><div class="speech rich-text"><span class="speaker">ann</span><p><a class="pb-label rich-text" data-page="1" target="_blank">(p.1, l.1)</a><span class="stage-direction">(bows)</span>\xa0\xa0hello §w </p></div><div class="speech plain-text"><p>ann — (bows)\xa0\xa0hello §w </p></div><h3 class="editorial-coord rich-text" id="1_2">p.1, l.2</h3><div class="speech rich-text"><span class="speaker">bob</span><p><span class="prakrit"><span class="lb-label rich-text" data-line="2">(p.1, l.2)</span>foo <span class="stage-direction">(aside)</span>\xa0\xa0bar<span class="chaya">gloss §k</span></span> baz </p></div><div class="speech plain-text"><p>bob — foo (aside)\xa0\xa0bar (gloss §k) baz </p></div><h3 class="editorial-coord rich-text" id="1_3">p.1, l.3</h3><div class="speech rich-text"><span class="speaker">cid</span><ul class="verses"><li class="verse rich-text"><ul class="padas"><li><span class="lb-label rich-text" data-line="4">(p.1, l.4)</span>kim §k |</li><li>ta || 1 ||</li></ul><div class="chaya"><ul class="padas"><li>one</li><li>two</li></ul></div></li></ul></div><div class="speech plain-text"><p>cid — </p><div class="lg plain-text"><span>kim §k |</span><span>ta || 1 ||</span><div class="chaya"><span>one</span><span>two</span></div></div></div><div class="speech rich-text"><span class="speaker">dan</span><ul class="verses"><li class="verse rich-text"><ul class="padas"><li style="--stagger-para: 5.5ch; --stagger-lines: 2.75ch">iti |</li><li style="--stagger-para: 11ch">ca || 2 ||</li></ul></li></ul></div><div class="speech plain-text"><p>dan — </p><div class="lg plain-text"><span>iti |</span><span>ca || 2 ||</span></div></div></div>',
    2: '<div id="content" class="hide-editorial-coords"><h1 id="Verses">§ Verses</h1><h3 class="editorial-coord rich-text" id="§n_1">p.§n, l.1</h3><ul class="verses rich-text"><li class="lg-head rich-text"><a class="pb-label rich-text" data-page="§n" target="_blank">(p.§n, l.1)</a>as is said |</li><li class="verse rich-text"><ul class="padas"><li>aaa §w<br class="lb-br rich-text"/>ccc |</li><li>eee || §k ||  itithus |</li></ul></li><li class="verse rich-text"><ul class="padas"><li>ggg || 2 ||</li></ul></li></ul><div class="lg plain-text"><p class="lg-head">as is said |</p><span>aaa §w</span><span>ccc |</span><span>eee || §k ||  itithus |</span></div><div class="lg plain-text"><span>ggg || 2 ||</span></div><p class="rich-text">prose after </p><p class="plain-text">prose after </p><ul class="verses rich-text"><li class="verse rich-text" id="v1-1"><ul class="padas"><li>lorem §w |</li><li>ipsum <a class="pb-label rich-text" data-page="7" target="_blank">(p.7, l.1)</a>dolor || <b>1.1</b> ||</li></ul></li></ul><div class="lg plain-text"><span>lorem §w |</span><span>ipsum  dolor || 1.1 ||</span></div></div>',
}
FACTS = {
    0: '{"title": "§k", "has_toc": true, "toc": [{"name": "Part §w", "page": "§n", "id": "Part_§w"}], "metadata_entries": [{"type": "corrections", "count": 3, "rows": [{"sic": "x", "corr": "y", "page": "§n", "line": "3", "coord_id": "§n_1"}, {"sic": "z", "corr": "", "page": "§n", "line": "5", "coord_id": "§n_5"}, {"sic": "", "corr": "q", "page": "§n", "line": "5", "coord_id": "§n_5"}]}], "has_verses": false, "has_editorial_coords": true, "has_line_breaks": true, "has_corrections": true, "no_line_numbers": false, "drama": false, "has_chaya": false}',
    1: '{"title": "§k", "has_toc": true, "toc": [{"name": "Act §w", "page": "1", "id": "Act_§w"}], "metadata_entries": [], "has_verses": true, "has_editorial_coords": true, "has_line_breaks": true, "has_corrections": false, "no_line_numbers": false, "drama": true, "has_chaya": true}',
    2: '{"title": "§k", "has_toc": true, "toc": [{"name": "Verses", "page": "§n", "id": "Verses"}], "metadata_entries": [], "has_verses": true, "has_editorial_coords": true, "has_line_breaks": false, "has_corrections": false, "no_line_numbers": false, "drama": false, "has_chaya": false}',
}
GLOSSES = {
    0: [],
    1: ['gloss §k', 'one\ntwo'],
    2: [],
}
#: seq, parent_seq, end_seq, depth, tag, text, tail
NODES = {
    0: [
        (0, None, 16, 0, 'body', '', ''),
        (1, 0, 16, 1, 'div', '', ''),
        (2, 1, 2, 2, 'pb', '', ''),
        (3, 1, 11, 2, 'p', 'alpha §w ', ''),
        (4, 3, 4, 3, 'lb', '', ' gam'),
        (5, 3, 5, 3, 'lb', '', 'ma '),
        (6, 3, 8, 3, 'choice', '', ' end '),
        (7, 6, 7, 4, 'sic', 'x', ''),
        (8, 6, 8, 4, 'corr', 'y', ''),
        (9, 3, 9, 3, 'pb', '', ' far '),
        (10, 3, 10, 3, 'lb', '', ''),
        (11, 3, 11, 3, 'milestone', '', ''),
        (12, 1, 16, 2, 'p', 'more ', ''),
        (13, 12, 13, 3, 'del', 'z', ' '),
        (14, 12, 14, 3, 'supplied', 'q', ' '),
        (15, 12, 15, 3, 'unclear', 'r', ' & so '),
        (16, 12, 16, 3, 'lb', '', ''),
    ],
    1: [
        (0, None, 28, 0, 'body', '', ''),
        (1, 0, 28, 1, 'div', '', ''),
        (2, 1, 3, 2, 'p', '', ''),
        (3, 2, 3, 3, 'stage', 'all enter\nslowly', ' '),
        (4, 1, 4, 2, 'p', 'now ', ''),
        (5, 1, 8, 2, 'sp', '', ''),
        (6, 5, 6, 3, 'speaker', 'ann', ''),
        (7, 5, 8, 3, 'p', '', ''),
        (8, 7, 8, 4, 'stage', 'bows', ' hello §w '),
        (9, 1, 14, 2, 'sp', '', ''),
        (10, 9, 10, 3, 'speaker', 'bob', ''),
        (11, 9, 14, 3, 'p', '', ''),
        (12, 11, 14, 4, 'seg', 'foo ', ' baz '),
        (13, 12, 13, 5, 'stage', 'aside', ' bar'),
        (14, 12, 14, 5, 'seg', 'gloss §k', ''),
        (15, 1, 23, 2, 'sp', '', ''),
        (16, 15, 16, 3, 'speaker', 'cid', ''),
        (17, 15, 23, 3, 'lg', '', ''),
        (18, 17, 19, 4, 'l', '', ''),
        (19, 18, 19, 5, 'lb', '', 'kim §k |'),
        (20, 17, 20, 4, 'l', 'ta || 1 ||', ''),
        (21, 17, 23, 4, 'lg', '', ''),
        (22, 21, 22, 5, 'l', 'one', ''),
        (23, 21, 23, 5, 'l', 'two', ''),
        (24, 1, 28, 2, 'sp', '', ''),
        (25, 24, 25, 3, 'speaker', 'dan', ''),
        (26, 24, 28, 3, 'lg', '', ''),
        (27, 26, 27, 4, 'l', 'iti |', ''),
        (28, 26, 28, 4, 'l', 'ca || 2 ||', ''),
    ],
    2: [
        (0, None, 15, 0, 'body', '', ''),
        (1, 0, 15, 1, 'div', '', ''),
        (2, 1, 10, 2, 'lg', '', ''),
        (3, 2, 8, 3, 'lg', '', ''),
        (4, 3, 4, 4, 'head', 'as is said |', ''),
        (5, 3, 6, 4, 'l', 'aaa §w', ''),
        (6, 5, 6, 5, 'caesura', '', 'ccc |'),
        (7, 3, 7, 4, 'l', 'eee || §k ||  iti', ''),
        (8, 3, 8, 4, 'back', 'thus |', ''),
        (9, 2, 10, 3, 'lg', '', ''),
        (10, 9, 10, 4, 'l', 'ggg || 2 ||', ''),
        (11, 1, 11, 2, 'p', 'prose after ', ''),
        (12, 1, 15, 2, 'lg', '', ''),
        (13, 12, 13, 3, 'l', 'lorem §w |', ''),
        (14, 12, 15, 3, 'l', 'ipsum ', ''),
        (15, 14, 15, 4, 'pb', '', ' dolor ||'),
    ],
}
