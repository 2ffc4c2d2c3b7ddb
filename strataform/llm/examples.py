"""Inspected examples of each kind of text, and words that link the parts of a sentence.

The texts are invented.  Each has its kind, and the group of shapes it shows.
"""

# Conjunctions, pronouns, auxiliaries and prepositions of running sentences,
# without articles and the words that join a noun to another.
LINKING = tuple(
    (
        # English
        "and but that because while when although with by at in for as so yet was were have has had is are it not who after before until during despite if did about without under there to we they said than this would been on near between just once last since"
        # Spanish
        " y pero que porque mientras cuando aunque con por en para como fue han ha se no sin según antes después durante hubo dijo ante desde entre según tras casi"
        # French
        " et mais qui parce pendant lorsque quand avec par dans pour comme était ont est il elle ne pas sans avant après depuis dit alors donc car devant sous pourquoi malgré entre presque tandis selon"
        # German
        " und aber dass weil während als wenn obwohl mit durch bei für wie war haben hat ist sie es nicht ohne vor nach bis trotz sagte wegen denn doch auf im am zum warum unter vom aus seit kurz fast zwischen hat stieg"
        # Portuguese
        " e mas embora enquanto quando com são foi foram tinham não sem depois antes disse apesar numa pela pelo houve portanto sob entre perante quase segundo desde"
        # Italian
        " ed ma perché mentre quando sebbene con per sono era ha hanno non senza dopo prima detto durante nonostante ci dalla nella alla fra sotto secondo quasi davanti dopo quindi sulla"
        # Dutch
        " en maar dat omdat terwijl toen hoewel met door bij voor werd heeft zijn niet zonder na zei naar onder er dus want op om waarom tussen sinds bijna steeg vanuit volgens ondanks"
    ).split()
)

_BULLETS = "a clean towel\n{0} the second drawer\n{0} an old harbour (Norvik Foods)\n{0} the spare keys\n{0} a broken fence (Halden Group)\n{0} the market stall\n{0} the ferry timetable\n{0} several loose bricks"

EXAMPLES: tuple[tuple[str, str, str], ...] = (
    # prose
    ("prose", "prose", "When the river had risen, the mayor of the town closed the old bridge and asked the drivers to wait. Nobody complained, because the water was still coming up. “We have seen this before,” said the ferryman after a while."),
    ("prose", "prose", "The bakery sold bread for a week without any help from the owner. Sales rose by 4.5 percent during the summer, although the street was being repaired. Did anyone know that the oven had been replaced?"),
    ("prose", "prose", "Cuando llegó el invierno, la maestra cerró la escuela durante dos semanas. Los vecinos dijeron que nadie había visto tanta nieve, pero el alcalde no respondió. Las ventas subieron un 3.2 por ciento en la comarca."),
    ("prose", "prose", "Lorsque le facteur est arrivé, la maison était vide et le chien dormait dans le jardin. Il y a eu 12 réponses, mais personne ne savait pourquoi la porte était ouverte. Le voisin a dit que tout allait bien."),
    ("prose", "prose", "Als der Zug am Abend ankam, wartete niemand auf dem Bahnsteig. Der Schaffner sagte, die Reisenden seien längst nach Hause gegangen, aber das Licht brannte noch. Es gab 40 Briefe, und keiner wurde gelesen."),
    ("prose", "prose", "Quando a chuva parou, o pescador voltou ao porto com dois barcos. Cerca de 20 das famílias esperavam no cais, embora a noite fosse fria. As vendas subiram 6.1 por cento durante o verão."),
    ("prose", "prose", "Quando il mercato ha aperto, la fioraia ha venduto tutte le rose in un'ora. Il sindaco ha detto che nessuno lo sapeva, ma le strade erano piene. Ci sono state 30 lettere dopo la festa."),
    ("prose", "prose", "Toen de winkel sloot, bracht de bakker het brood naar het plein. Er waren 15 vragen, maar niemand zei iets over de prijs. De omzet steeg met 2.4 procent tijdens de zomer, want het weer was goed."),
    ("prose", "wrapped", "The carpenter measured the doors of the house before the\nrain came, and the painter waited outside until the wood was\ndry. Nobody had told him that the windows were to be replaced\nas well, because the letter had been lost."),
    ("prose", "wrapped", "El carpintero midió las puertas antes de que llegara la\nlluvia, y el pintor esperó fuera hasta que la madera estuvo\nseca. Nadie le había dicho que las ventanas también se\ncambiarían, porque la carta se perdió."),
    ("prose", "wrapped", "Der Tischler vermaß die Türen vor dem Regen, und der Maler\nwartete draußen, bis das Holz trocken war. Niemand hatte ihm\ngesagt, dass auch die Fenster ersetzt werden, weil der Brief\nverloren ging."),
    ("prose", "wrapped", "Le menuisier a mesuré les portes avant la pluie, et le\npeintre a attendu dehors. Personne ne lui avait dit que les\nfenêtres seraient remplacées, parce que la lettre était\nperdue."),
    ("prose", "bare", "the gardener watered the plants before the sun came up while the neighbours were asleep there were 12 letters in the box and nobody had read them because the postman was late for the third time turnover at the shop rose by 31 percent during the week"),
    ("prose", "bare", "el jardinero regó las plantas antes de que saliera el sol mientras los vecinos dormían hubo 12 cartas en el buzón y nadie las había leído porque el cartero llegó tarde por tercera vez las ventas de la tienda subieron un 31 por ciento"),
    ("prose", "bare", "der gärtner goss die blumen vor dem sonnenaufgang während die nachbarn schliefen es gab 12 briefe im kasten und niemand hatte sie gelesen weil der bote zum dritten mal zu spät kam der umsatz stieg um 31 prozent"),
    ("prose", "bare", "le jardinier a arrosé les plantes avant le lever du soleil pendant que les voisins dormaient il y a eu 12 lettres dans la boîte et personne ne les avait lues parce que le facteur était en retard"),
    ("prose", "marked", "1. The owner of the mill replaced the old door on the eve of the feast.\n(2) The owner of the mill replaced the old door on the eve of the feast!!\n>> The owner of the mill replaced the old door on the eve of the feast."),
    ("prose", "marked", "- Der Müller ersetzte die alte Tür am Vorabend des Festes.\n>> DER MÜLLER ERSETZTE DIE ALTE TÜR AM VORABEND DES FESTES.\n4. der Müller ersetzte die alte Tür am Vorabend des Festes!!"),
    ("prose", "marked", ">> El dueño del molino cambió la puerta vieja en la víspera de la fiesta.\n(5) EL DUEÑO DEL MOLINO CAMBIÓ LA PUERTA VIEJA EN LA VÍSPERA DE LA FIESTA.\n6. El dueño del molino cambió la puerta vieja en la víspera de la fiesta!!"),
    ("prose", "marked", "1. Le patron du moulin a remplacé la vieille porte malgré la pluie.\n>> Le  patron  du moulin a remplacé la vieille porte malgré la pluie!!"),
    ("prose", "marked", "(3) Il padrone del mulino ha cambiato la vecchia porta alla vigilia della festa.\n>> IL PADRONE DEL MULINO HA CAMBIATO LA VECCHIA PORTA ALLA VIGILIA DELLA FESTA."),
    ("prose", "sentence", "Did the owner of the mill know that the bridge was closed?"),
    ("prose", "sentence", "The teacher of the village said that nobody had seen the keys."),
    ("prose", "sentence", "La maestra del pueblo dijo que nadie había visto las llaves."),
    ("prose", "sentence", "Warum verschob der Lehrer die Reise trotz des guten Wetters?"),
    ("prose", "title", "The gardener sold the old greenhouse"),
    ("prose", "title", "Die Lehrerin ersetzte den alten Fahrplan"),
    ("prose", "title", "El panadero cerró la tienda vieja"),
    # lists
    *(("list", "bulleted", f"{b} " + _BULLETS.format(b)) for b in ("-", "*", "•", "[ ]", "–")),
    ("list", "bulleted", "- une serviette propre\n- le vieux port (Norvik Foods)\n- les clés de rechange\n- la clôture du jardin\n- un marché couvert\n- l'horaire du bateau"),
    ("list", "bulleted", "• das saubere Tuch\n• der alte Hafen\n• die Ersatzschlüssel (Halden Group)\n• der Zaun im Garten\n• die Fahrpläne der Fähre"),
    ("list", "numbered", "1. the second drawer\n2. an old harbour\n3. the spare keys (Halden Group)\n4. a broken fence\n5. the market stall"),
    ("list", "numbered", "1) la segunda gaveta\n2) un puerto viejo\n3) las llaves de repuesto\n4) la valla rota (Norvik Foods)\n5) el puesto del mercado"),
    ("list", "plain", "the second drawer\nan old harbour (Norvik Foods)\nthe spare keys\na broken fence\nthe market stall (Halden Group)\nthe ferry timetable\nseveral loose bricks\na clean towel"),
    ("list", "plain", "la segunda gaveta\nun puerto viejo (Norvik Foods)\nlas llaves de repuesto\nla valla rota\nel puesto del mercado\nel horario del barco (Halden Group)"),
    ("list", "plain", "die zweite Schublade\nein alter Hafen (Norvik Foods)\ndie Ersatzschlüssel\nder Zaun\nder Marktstand (Halden Group)\nmehrere lose Ziegel"),
    ("list", "menu", "Spare keys\nOld harbour »\nFerry timetable (12)\nMarket stall\nBroken fence >\nSecond drawer\nClean towel (81)\nLoose bricks »\nMarket stall >"),
    ("list", "menu", "Llaves de repuesto\nPuerto viejo »\nHorario del barco (12)\nPuesto de mercado\nValla rota >\nSegunda gaveta\nLadrillos sueltos »"),
    ("list", "menu", "Ersatzschlüssel\nAlter Hafen »\nFahrplan der Fähre (12)\nMarktstand\nZaun >\nZweite Schublade\nLose Ziegel »"),
    ("list", "keywords", "spare keys,old harbour,ferry timetable,market stall,broken fence,second drawer,clean towel,loose bricks,market stall,old harbour"),
    ("list", "keywords", "spare keys #old harbour #ferry timetable #market stall #broken fence #second drawer #clean towel #loose bricks #market stall"),
    ("list", "keywords", "Ersatzschlüssel | Hafen | Fahrplan | Marktstand | Zaun | Schublade | lose Ziegel | Hafen | sauberes Tuch | Marktstand"),
    ("list", "keywords", "llaves de repuesto / puerto viejo / horario del barco / puesto de mercado / valla rota / segunda gaveta / ladrillos sueltos"),
    ("list", "keywords", "clés de rechange; vieux port; horaire du bateau; marché couvert; clôture; serviette propre; briques"),
    # tables
    ("table", "piped", "| The old harbour | 4182 | 21.75 | +0.4% |\n| A clean towel | 917 | 80.10 | -3.3% |\n| The spare keys | 52210 | 5.02 | +7.9% |"),
    ("table", "piped", "Norvik Foods | 22.6 | 0.6\nHalden Group | 83.3 | 7.3\nMerton Works | 41.0 | 2.2"),
    ("table", "tabbed", "The old harbour\t4182\t21.75\t+0.4%\nA clean towel\t917\t80.10\t-3.3%\nThe spare keys\t52210\t5.02\t+7.9%"),
    ("table", "tabbed", "Norvik Foods\t4182\t21.75\t+0.4%\nHalden Group\t917\t80.10\t-3.3%\nMerton Works\t52210\t5.02\t+7.9%"),
    ("table", "semicolons", "The old harbour;4182;21.75;+0.4%\nA clean towel;917;80.10;-3.3%\nThe spare keys;52210;5.02;+7.9%\nNorvik Foods;52210;5.02;+7.9%"),
    ("table", "aligned", "The old harbour                     4182       21.75       +0.4%\nA clean towel                        917       80.10       -3.3%\nThe spare keys                     52210        5.02       +7.9%\nNorvik Foods                        5210        5.02       +7.9%"),
    # junk
    ("junk", "contacts", "Ona Merrit, Norvik Foods 85, +00 412 40559, ona.merrit@norvik.example\nPer Halden, Halden Group 20, +00 963 97147, per.halden@halden.example\nIda Ros, Merton Works 7, +00 125 55241, ida.ros@merton.example"),
    ("junk", "log", "2030-02-01T00:07:13Z INFO abkf-bohdd[2636] fid=8uq5vvErjVvq acchgk/hibinoi rc=5\n2030-02-01T00:12:02Z WARN agg-ogejn[3467] oid=aVY3eK1PhCq4 acmfi/eihpmof rc=1\n2030-02-01T00:26:36Z ERR anch-hbeff[2686] oid=fXOZRFpCHutG ghimhp/ophgm rc=1"),
    ("junk", "json", '{"id": 95739, "nm": "Norvik Foods", "px": 187.08, "k": "ogoPpC"}\n{"id": 7216, "nm": "Halden Group", "px": 0.62, "k": "1enOQ6"}\n{"id": 58469, "nm": "Merton Works", "px": 174.44, "k": "Cd9NQv"}'),
    ("junk", "code", "def pad_row(cell):\n    return width * 64\nconst row_b = (cell) => pad[83];\nif (row != col) { pad += 76; }\nsum_a = [f_b for g_c in zq90]\n#main > .cell_a { row_h: 48px }"),
    ("junk", "hex", "00000000  80 69 f1 aa 40 1c f8 f2 1e ae 7e 1c ad 3a a1 14\n00000010  0c 41 e6 ef 40 a8 0e 2b 99 fc 60 65 80 68 35 1e\n00000020  9a 69 df df 29 36 7a 87 01 ed 02 3d 7d 25 83 ce"),
    ("junk", "base64", "fkKjdbSa99J1E43d66lFpGsFg/b6Bpe0ADPlfmYLXrWq3f4ewTZbzwYVG8fZBP89GRu/PMSpGDay\nK0pzGvbHGHDvFbClbh0VhTHTt0bPw4K441Q0/MFqxusjxjXBgmEDOD+XVhDajrlTP8KvkgO61XTi"),
    ("junk", "percent", "%F7%EB%65%8E%09%6A%D7%41%0C%10%1C%52%5A%91%95%2A%AA%7F%71%A6%33%CF%8F%C1%C1%3D%41%1E%9D%F3%32%62%09%D7%7F%AF"),
    ("junk", "symbols", "@#?*#\n+&%&>*\n@%$>\n#=>$>~+&>$>\n+$%~?!?=#>&\n!>%&=?!\n!<&$<=?&~@^%\n*^~?~#^"),
    ("junk", "mash", "swhqfedgjgk djedqhekjgfh ljlqgfglwj la asgawlwflswd eakqksqf elfekflgwese wk gllddeesqkgq qsegwe qjkfjwgfjl hlkawkghahk efhkddsall"),
    ("junk", "keys", "hkm\n;k;b\ngkjgmj[\ngkkzgnckk\ngbcgbbn\n]gh\nbc[cm\ncjgc;gz\nzk\nmx;]xn\ngjhjkzhgvm"),
    ("junk", "scan", "Tl 1e  fcrry  m@n ~+0ppcd  +hc  b 0@t  @nd  w @i+cd  1n  ~ +hc  r a1n  b ccau5c  n0 b0 dy  h@d  5cc n  h1 m"),
    ("junk", "scan", "L e  p1 @n  d c5  p0r te5 ,  @ 1~5  q u^e  un^  ^+r @ duc  ~bé^r1é  d c v@n +  |1 5  m ur5  c1  d 1 @ng1e5"),
)
