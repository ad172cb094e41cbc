"""Pages written and labelled by hand: (html, the blocks of main text)."""

PAGES = [
    # body names
    ('<html><body class="single-post with-sidebar comments-open"><nav><a href=/>Home</a> <a href=/n>News</a></nav><article><h1>Council votes on bridge</h1><p>The council voted on Tuesday to rebuild the old bridge over the river. Work starts in May.</p><p>Critics say that the cost is too high for a town of this size.</p></article><footer>© 2020 Town Paper</footer></body></html>',
        ["Council votes on bridge","The council voted on Tuesday to rebuild the old bridge over the river. Work starts in May.","Critics say that the cost is too high for a town of this size."]),
    # header in article
    ('<body><header><a href=/>The Daily</a></header><main><article><header><h1>A long winter ends</h1></header><p>Snow has melted in the hills, and farmers are back in their fields after five months.</p><p>Prices of hay have doubled since November.</p></article></main><aside><h3>Most read</h3><ul><li><a href=1>Ten recipes</a><li><a href=2>New train line</a></ul></aside><footer><p>All rights reserved.</p></footer></body>',
        ["A long winter ends","Snow has melted in the hills, and farmers are back in their fields after five months.","Prices of hay have doubled since November."]),
    # names that mislead
    ('<body><nav><ul><li><a href=/>Start</a><li><a href=/c>Cases</a></ul></nav><main><div class="form-group legal-analysis"><h1>What the ruling means</h1><p>The court held that the contract was void from the beginning, because neither party had signed it.</p><p>Appeals remain possible until the end of the year, but lawyers expect none.</p></div></main><footer>Legal Weekly · Contact</footer></body>',
        ["What the ruling means","The court held that the contract was void from the beginning, because neither party had signed it.","Appeals remain possible until the end of the year, but lawyers expect none."]),
    # names without meaning
    ('<body><div class="x91"><a href=/a>One</a><a href=/b>Two</a><a href=/c>Three</a></div><div class="q7"><h1>How bees find home</h1><p>Bees steer by the sun, by landmarks, and by the smell of their hive, as a new study shows.</p><p>The team followed four hundred bees with tiny radar tags over two summers.</p><p>Only a few got lost, most of them on cloudy days.</p></div><div class="zz"><span>We use cookies to improve your experience.</span><button>Accept</button></div></body>',
        ["How bees find home","Bees steer by the sun, by landmarks, and by the smell of their hive, as a new study shows.","The team followed four hundred bees with tiny radar tags over two summers.","Only a few got lost, most of them on cloudy days."]),
    # German ids
    ('<body><div id="kopf"><a href=/>Zeitung</a></div><div id="inhalt"><h1>Neue Brücke eröffnet</h1><p>Nach drei Jahren Bauzeit ist die neue Brücke am Montag für den Verkehr freigegeben worden.</p><p>Die Kosten lagen deutlich höher als geplant, sagte die Bürgermeisterin.</p></div><div id="kommentare"><h3>Kommentare</h3><p>Endlich! Das hat lange genug gedauert.</p></div><div id="fuss">© Zeitung Impressum</div></body>',
        ["Neue Brücke eröffnet","Nach drei Jahren Bauzeit ist die neue Brücke am Montag für den Verkehr freigegeben worden.","Die Kosten lagen deutlich höher als geplant, sagte die Bürgermeisterin."]),
    # math
    ('<body><article><h1>Squares</h1><p>For every number <math><mi>x</mi></math> its square is never negative, which is easy to see from the graph.</p><p>The converse is not true for complex numbers.</p></article></body>',
        ["Squares","For every number x its square is never negative, which is easy to see from the graph.","The converse is not true for complex numbers."]),
    # French, aside and share inside
    ('<body><div class="bandeau"><p>Nous utilisons des cookies.</p><button>Tout accepter</button></div><div class="contenu"><h1>Le marché rouvre</h1><p>Le marché couvert a rouvert ses portes samedi matin après deux ans de travaux importants.</p><div class="partager"><a href=1>Partager</a> <a href=2>Imprimer</a></div><p>Les commerçants attendent beaucoup de monde pendant les fêtes de fin d\'année.</p></div><div class="commentaires"><div class="c"><b>Luc</b> <time>il y a 3 heures</time><p>Très bonne nouvelle pour le quartier.</p><a href=#>Répondre</a></div></div><div class="pied">Mentions légales</div></body>',
        ["Le marché rouvre","Le marché couvert a rouvert ses portes samedi matin après deux ans de travaux importants.","Les commerçants attendent beaucoup de monde pendant les fêtes de fin d'année."]),
    # form and advert after
    ('<body><header><h1>Garden Blog</h1><nav><ul><li><a href=/>Home</a></li><li><a href=/about>About us</a></li></ul></nav></header><div class="post"><h2>Planting tulips in autumn</h2><p>Dig holes three times as deep as the bulbs are high, and put some sand at the bottom.</p><ul><li>Water them once after planting.</li><li>Cover the bed with leaves.</li></ul></div><div class="advert">Buy bulbs now and save 20%</div><form class="newsletter"><label>Email address</label><input><button>Subscribe</button></form><div class="footer">Powered by Press</div></body>',
        ["Planting tulips in autumn","Dig holes three times as deep as the bulbs are high, and put some sand at the bottom.","Water them once after planting.","Cover the bed with leaves."]),
    # comments as articles in main
    ('<body><main><article><h1>Bus lanes stay</h1><p>The bus lanes on Main Street will stay after a year of trials, the city said on Monday morning.</p><blockquote><p>It is faster now than it ever was, said a driver.</p></blockquote></article><section class="comments"><h2>2 comments</h2><article class="comment"><b>Ann</b> <time>2 hours ago</time><p>I still think that they should go, there are so few buses.</p><a href=#>Reply</a></article><article class="comment"><b>Bo</b><p>Great news for all of us who ride.</p></article></section></main><footer>Privacy policy</footer></body>',
        ["Bus lanes stay","The bus lanes on Main Street will stay after a year of trials, the city said on Monday morning.","It is faster now than it ever was, said a driver."]),
    # Spanish with sidebar in wrapper
    ('<body><div id="wrapper"><div id="navegacion"><ul><li><a href=1>Inicio</a></li><li><a href=2>Deportes</a></li></ul></div><div id="cuerpo"><h1>El río crece</h1><p>El nivel del río subió dos metros durante la noche y varias calles quedaron cerradas al tráfico.</p><p>Los vecinos pasaron la noche en la escuela, donde hay comida y mantas para todos.</p></div><div id="lateral"><h3>Te puede interesar</h3><p><a href=9>Lluvias en el norte</a></p></div></div><div id="pie">© Diario. Todos los derechos reservados.</div></body>',
        ["El río crece","El nivel del río subió dos metros durante la noche y varias calles quedaron cerradas al tráfico.","Los vecinos pasaron la noche en la escuela, donde hay comida y mantas para todos."]),
    # no containers at all
    ('<body><p><a href=/>Back to the index</a></p><h1>Notes on rope</h1><p>A rope of hemp swells when wet, and so holds better on a winch than one of nylon does.</p><p>It also rots, so it must be dried before it is stowed away below deck.</p><hr><p>© 1998 A. Sailor</p></body>',
        ["Notes on rope","A rope of hemp swells when wet, and so holds better on a winch than one of nylon does.","It also rots, so it must be dried before it is stowed away below deck."]),
    # table and figure
    ('<body><nav><a href=/>Home</a></nav><article><h1>Rain by month</h1><p>The table shows how much rain fell in the first two months of the year at our station.</p><table><tr><td>January</td><td>80 mm</td></tr><tr><td>February</td><td>61 mm</td></tr></table><figure><img src=x><figcaption>The station in the hills.</figcaption></figure></article><aside class="sidebar"><h3>Archives</h3><ul><li><a href=1>May</a><li><a href=2>June</a></ul></aside><footer>© Weather Club</footer></body>',
        ["Rain by month","The table shows how much rain fell in the first two months of the year at our station.","January","80 mm","February","61 mm","The station in the hills."]),
]

# Names of elements and phrases of side matter that occur nowhere in the layouts that the labeller learns from (a test asserts that), in languages that they don't have.
UNSEEN = [
    # Polish
    ('<body><div id="gora"><a href=/>Gazeta Miejska</a> <a href=/s>Szukaj</a></div><div id="tresc"><h1>Nowy most otwarty</h1><p>Po trzech latach budowy nowy most został otwarty dla ruchu w poniedziałek rano.</p><p>Koszty były znacznie wyższe niż planowano, powiedział 14 maja burmistrz miasta.</p></div><div id="opinie"><h3>Opinie czytelników</h3><div><b>Jan</b> <p>Nareszcie, trwało to zbyt długo.</p></div></div><div id="stopka">© Gazeta Miejska</div></body>',
        ["Nowy most otwarty", "Po trzech latach budowy nowy most został otwarty dla ruchu w poniedziałek rano.", "Koszty były znacznie wyższe niż planowano, powiedział 14 maja burmistrz miasta."]),
    # Swedish, a wrapper around all
    ('<body><div class="sida"><div class="meny"><ul><li><a href=1>Hem</a></li><li><a href=2>Kultur</a></li><li><a href=3>Väder</a></li></ul></div><div class="brodtext"><h1>Isen lade sig tidigt</h1><p>Sjön frös redan i november i år, vilket inte har hänt sedan 1987 enligt byns äldsta fiskare.</p><p>Den som vill åka skridskor bör ändå vänta några veckor till.</p><p>Isen är bara 4 centimeter tjock vid stranden.</p></div><div class="hoger"><h3>Andra läste</h3><ul><li><a href=8>Ny färja</a></li><li><a href=9>Bokmässan</a></li></ul></div></div></body>',
        ["Isen lade sig tidigt", "Sjön frös redan i november i år, vilket inte har hänt sedan 1987 enligt byns äldsta fiskare.", "Den som vill åka skridskor bör ändå vänta några veckor till.", "Isen är bara 4 centimeter tjock vid stranden."]),
    # numbers in every paragraph, names without meaning
    ('<body><div class="k1"><a href=/>Start</a><a href=/r>Results</a></div><div class="k2"><h1>Results of round 7</h1><p>Team 1 beat team 4 by 3 goals to 1 after a slow first half on the wet pitch.</p><p>Team 2 and team 3 drew 0 to 0, and both keepers had little to do all day.</p><p>Round 8 is on May 14 at 15:00, when teams 1 and 2 meet for the first time.</p></div><div class="k3"><a href=/i>Imprint of the league</a></div></body>',
        ["Results of round 7", "Team 1 beat team 4 by 3 goals to 1 after a slow first half on the wet pitch.", "Team 2 and team 3 drew 0 to 0, and both keepers had little to do all day.", "Round 8 is on May 14 at 15:00, when teams 1 and 2 meet for the first time."]),
    # questions and answers that unfold
    ('<body><nav><a href=/>Front</a> <a href=/q>Questions</a></nav><main><h1>Questions about the library</h1><details><summary>Who may borrow books?</summary><p>Everyone who lives in the county may borrow books for four weeks.</p></details><details><summary>What does a lost book cost?</summary><p>It costs what the library pays for a new one.</p></details></main><footer><p>County library, Mill Lane 3</p></footer></body>',
        ["Questions about the library", "Who may borrow books?", "Everyone who lives in the county may borrow books for four weeks.", "What does a lost book cost?", "It costs what the library pays for a new one."]),
    # a glossary, sources at the end
    ('<body><div class="oben"><a href=/>Wood lore</a></div><article><h1>Words of the forest</h1><p>Foresters have words of their own, and some of them are older than the maps of the place.</p><dl><dt>Coppice</dt><dd>Trees that are cut near the ground and grow again.</dd><dt>Ride</dt><dd>A broad path that was made for horses.</dd></dl><h2>Sources</h2><ul><li>County archive, box 12</li><li>Hale, Old Woods</li></ul></article><div class="unten">Wood lore society</div></body>',
        ["Words of the forest", "Foresters have words of their own, and some of them are older than the maps of the place.", "Coppice", "Trees that are cut near the ground and grow again.", "Ride", "A broad path that was made for horses.", "Sources", "County archive, box 12", "Hale, Old Woods"]),
    # an interview, speakers in bold
    ('<body><header><p>Radio North</p></header><main><h1>Talk with a lighthouse keeper</h1><p><b>How long were you there?</b></p><p>For 31 years, until the light was made to work by itself.</p><p><b>Was it lonely?</b></p><p>Not with so many birds around the house all day.</p><p><b>Would you do it again?</b></p><p>I would, but only if my dog could come along.</p></main><footer><a href=/k>Write to the station</a></footer></body>',
        ["Talk with a lighthouse keeper", "How long were you there?", "For 31 years, until the light was made to work by itself.", "Was it lonely?", "Not with so many birds around the house all day.", "Would you do it again?", "I would, but only if my dog could come along."]),
]
