"""The default vocabulary of subjects: weighted terms in English, German and Spanish, lower case.

Three strengths per subject: ``strong`` terms name the subject by themselves, ``plain`` ones usually do, ``weak`` ones have
other meanings too (or are usual words of company names) and count only together with others. A term ends where its word
ends, apart from usual endings (:data:`ENDINGS`); a star stands for any letters at that end of the word. Pass a
vocabulary of your own to ``subjects_of`` for other subjects or languages.
"""

from __future__ import annotations

#: Endings that a term's last word may take.
ENDINGS = ("s", "es", "e", "n", "en", "er", "ern", "em", "d", "ed", "ing")

STRONG, PLAIN, WEAK = 2.0, 1.0, 0.5

_TEXT = {
    "agrifood": {
        STRONG: """
agricultur*, agrochemical*, agribusiness, agronom*, arable, barley, beekeeper, cattle, cereal crop, cocoa bean, cocoa grower, coffee grower,
combine harvester, corn belt, cowshed, crop failure, crop yield, crop rotation, dairy cooperative, dairy farm, dairy herd, fertiliser, fertilizer,
farmer, farming, farmland, fishery, flour mill, fruit grower, grain elevator, grain merchant, grain trader, grazing, greenhouse tomato, harvest,
herbicide, hectare, horticultur*, irrigation, livestock, maize, meat packer, meat processor, milk price, milking, orchard, palm oil, pesticide,
poultry, rapeseed, seed company, silage, slaughterhouse, sowing, soybean, sugar beet, sugar mill, sugar cane, tractor, vineyard, wheat, winery,
wine grower, swine fever, bird flu, foot and mouth disease, food processing, grape harvest, olive grove, olive oil, feed cost, plough, stubble field,
landwirt*, bauern*, getreide*, saatgut*, molkerei*, milchpreis*, weizen*, roggen*, gerste*, ernte*, viehzucht*, schlachthof*, schlachthöf*, düngemittel*, ackerbau*,
weinbau*, winzer*, rinderherde*, futtermittel*, milchvieh*, schweinemast*, kartoffelernte*, obstbau*,
agricultor*, agrícola*, agropecuari*, cosecha*, ganader*, ganado*, trigo, maíz, cooperativa lechera, lechera*, empresa de semillas, semillas, comerciante de grano,
fertilizante*, regadío*, viñedo*, matadero*, olivar*, siembra*, pasto*, invernadero*
""",
        PLAIN: """
barn, blight, cheese, cow, crop, dairy, drought tolerant, flock, flour, grain, grove, growing season, herd, hybrid seed, milk, miller, nitrogen,
oat, pasture, pig farm, potato, rice paddy, rust disease, rye, seed, sheep, slaughter, sugar, vegetable, yield per acre, egg price, grape,
vieh*, kühe, rinder, schweine, milch, acker, tonnen weizen, überschüsse im apfelbau, vacas, cerdos, leche, grano, heladas, huerta, harina, aceite de oliva
""",
        WEAK: "food, foods, plant, bird, frost, meat, fruit, organic, quota, rain, feed, field, coffee, cocoa, butter, bread, boden, frucht, frost, carne, fruta, campo, lluvia",
    },
    "banking": {
        STRONG: """
bad debt, bad loan, bank account, bank branch, bank capital, bank deposit, bank run, banking, bank loan, banker, borrower, building society, card balance,
card portfolio, cash machine, commercial bank, commercial credit, commercial lender, consumer credit, consumer lending, core capital, credit card, credit institution,
credit quality, credit union, deposit base, deposit franchise, deposit insurance, depositor, doubtful loan, home loan, home lender, interest margin, lender, lending book,
liquidity rule, liquidity coverage, loan book, loan loss, loan portfolio, mortgage, net interest income, non-performing, overdraft, past due, payday loan, private bank,
retail bank, savings account, savings bank, savings deposit, stress test, teller, tier one, tier 1, capital buffer, capital ratio, treasury desk, wealth manager, wholesale funding,
write-off of loans, refinanc*, repayment, basel iii, basel rule, subprime,
sparkasse*, kreditinstitut*, hypothek*, spareinlage*, spareinlagen, einlagensicherung*, kernkapital*, risikovorsorge*, faule kredite, fauler kredite, kreditnehmer*, kreditvergabe*,
girokonto*, geldmarktfonds, bankfiliale*, landesbank*, privatbank*, großbank*, dispokredit*, kreditausfall*, bankkund*,
entidad de crédito, caja de ahorros, hipoteca*, área hipotecaria, préstamo*, morosidad*, depositante*, cuenta bancaria, cajero automático, tarjeta de crédito, banca minorista,
dudoso cobro, préstamos dudosos, concesión de créditos, sucursal bancaria, colchón de capital
""",
        PLAIN: """
days behind, behind on payment, doubtful,
banks, arrears, bank's, collateral, creditworth*, default rate, delinquenc*, deposit, loan, leverage, provisioning, underwriting, branch traffic, saver, savings, interest rate on,
money market fund, die bank, eine bank, der bank, banken, einlagen, kredite, kredit, darlehen*, zinsen auf, el banco, la banca, los bancos, bancos, depósitos, créditos, crédito, ahorros, intereses
""",
        WEAK: "households, reserves, bank, bancorp, financial, branch, credit, equity, capital, fee, rate, interest rate, tier, cash, withdraw, account, debt, filiale, konto, raten, cuenta, sucursal, capital",
    },
    "biomed": {
        STRONG: """
adverse reaction, antibiotic, antibody, artery, biopsy, biotech company, blood pressure, blood sample, blood test, breakthrough status, cancer, cardiolog*, chemotherap*, clinical hold,
clinical research, clinical study, clinical trial, diabet*, diagnostic kit, diagnostic test, dialysis, dose of, drug candidate, drug maker, drugmaker, drug trial, epidem*, gene mutation,
gene therapy, generic drug, heart attack, heart valve, hip joint, hospital, immune system, infectious disease, influenza, insulin, interim readout, leukaemia, leukemia, liver disorder,
liver disease, measles, medicines agency, medical device, medication, medicine, mutation, nurse, oncolog*, pacemaker, patholog*, patient, pharmacist, phase one trial, phase two trial,
phase three trial, phase ii, phase iii, physician, pivotal study, placebo, pneumonia, prescription drug, primary endpoint, independent safety board, radiolog*, scanner ward, side effect, stem cell, stroke patient,
statistical significance, surgeon, surgery, surgical, symptom, therapeutic, therapy, toxicit*, transplant, tumor, tumour, vaccin*, viral infection, 
arzneimittel*, arzneihersteller*, impfstoff*, klinische studie, klinischen studie, primären endpunkt, krankenhaus*, krankenhäuser*, medikament*, patient*, leberkrank*, lebererkrank*, blutdruck*, chirurg*,
krebs*, impfung*, ärzte, ärztin, pharmahersteller*, nebenwirkung*, therapie*, diabetiker*,
ensayo clínico, vacuna*, paciente*, enfermedad*, efectos adversos, autorización sanitaria, hospital*, medicamento*, cirujano*, cáncer, quimioterapia, anticuerpo*, fármaco*, farmacéutic*, sarampión,
laboratorio farmacéutico, enfermera*, médicos, tratamiento contra
""",
        PLAIN: """
clinic, doctor, disease, diagnos*, drug, dosage, endpoint, first volunteer, genom*, headache, health agency, infant, infection, inject, implant, implanted, laboratory, nausea, prescri*, pill, rare disorder, tablet dose,
trial arm, virus strain, x-ray, arzt, infektion*, studie mit, zulassung, endpunkt, el laboratorio, médico, clínica, tratamiento, dosis
""",
        WEAK: "medical, pharmaceuticals, pharma, trial, heart, blood, gene, joint, virus, laboratories, therapeutics, volunteer, cell, ward, approval, labor, corazón, sangre, virus",
    },
    "dataops": {
        STRONG: """
backfill, batch load, column mapping, corporate action, csv file, cursor pagination, data cleaning, data feed, data load, data pipeline, data provider, data quality check, data vendor, deduplicat*, duplicate key,
duplicate row, empty identifier, etl, exchange code, feed handler, figi, holiday calendar, identifier mapping, import job, isin, loader, market data, missing row, missing value, nightly load, nightly price, null close, null value,
partition writer, price feed, price history, price import, primary key, quote archive, record load, reference data, schema mismatch, schema change, sentinel value, sedol, cusip, stale quote, stale price, subscription run, symbol mapping,
ticker enrichment, ticker mapping, ticker symbol, timestamp format, time series load, upsert, vendor feed, vendor's file, vendor's server, adjusted close, adjusted history, daily file, header row, malformed row, rejected row, previous snapshot,
datenlieferant*, ladejob*, datenfeed*, kursimport*, datumsformat*, zeilen ohne kennung, datenqualität*, kursdaten*, datensätze ohne, schlusskurse*, ungültige werte, leere spalten,
proveedor de datos, carga nocturna, proceso de enriquecimiento, filas sin identificador, formato de fecha, campo vacío, base de referencia, datos de mercado, identificador del valor
""",
        PLAIN: """
alert raised, archive file, column, data set, dataset, deduplicated, feed, field format, file format, identifier, import failed, loaded twice, null, observation, page of results, parse error, parser, quote, record count, reload,
rerun, row count, rows, schema, snapshot, ticker, truncated, values in the file, doppelt, kennung*, spalten, zeilen, datei, dateien, importación*, identificador*, fichero*, filas, columna*, carga
""",
        WEAK: "renam*, data, header, key, history, page, archive, symbol, load, job, pipeline, file, download, retr*, format, dashboard, value, backup, record, daten, werte, seite, datos, valor, página, base",
    },
    "electronics": {
        STRONG: """
accelerator chip, amplifier, capacitor, chip designer, chip factory, chip maker, chipmaker, chip shortage, circuit board, clean room, contract manufacturer, display panel, etching tool, flash memory,
foundry, graphics card, handset, integrated circuit, interconnect, laptop, lead frame, led screen, lithograph*, low-power radio, memory chip, memory division, memory module, microchip, microcontroller, microprocessor,
nanometre, nanometer, new fab, printed circuit, processor core, resistor, semiconductor, sensor maker, silicon carbide, silicon wafer, smartphone, substrate, taped out, tape-out, transistor, wafer, solder*,
diode, oled, consumer electronics, electronic component, packaging line, image sensor, tablets and laptops,
halbleiter*, chipentwickler*, sensorhersteller*, chipfabrik*, speicherbaustein*, leiterplatte*, mikrochip*, transistor*, elektronikhersteller*, nanometer*, bildschirmhersteller*,
fábrica de obleas, obleas, diseñador de chips, fabricante de sensores, semiconductor*, módulos de memoria, rendimiento del nodo, microchip*, escasez de chips, circuito impreso, placa base
""",
        PLAIN: """
chips, die shrink, electronics, export licence, fab, lead time, processor, sampling, screens, sensor, utilisation, utilization, assembly line, automotive part, graphics, component, cores, monitor,
auslastung*, fertigung*, speicher, nodo, utilización, móviles, chips de, retrasó la planta
""",
        WEAK: "chip, board, yield, memory, node, radio, power, tool, distributor, die, panel, circuit, silicon, factory, inventories, planta, spule, werk, memoria, sensores",
    },
    "energy": {
        STRONG: """
barrels a day, barrels of oil, biofuel, blackout, brownout, carbon permit, coal mine, coal plant, coal unit, compressor station, crack spread, crude, cubic metres of gas, diesel price, drilling, electricity, fuel oil, gas field, gas pipeline,
gas price, gas storage, gasoline, geotherm*, grid operator, hydroelectric, hydropower, kilowatt, liquefied gas, liquefied natural gas, lng, megawatt, natural gas, nuclear, offshore operator, offshore wind, oil company, oil field, oil price,
oil production, oil rig, oil well, opec, peak demand, petrol, petroleum, photovoltaic, pipeline company, power grid, power plant, power station, proven reserve, refiner, refinery, rooftop solar, shale, solar panel, solar power, substation, the utility,
thermal coal, turbine, wind developer, wind farm, wind power, wind turbine, barrel, tank farm, oil terminal,
versorger*, netzbetreiber*, raffinerie*, kohlekraftwerk*, kernkraftwerk*, atomkraftwerk*, kraftwerk*, windstrom*, windräder*, windpark*, windkraft*, gasspeicher*, strompreis*, braunkohle*, erdgas*, erdöl*, ölpreis*, solarstrom*, ölförderung*, barrel*, stromnetz*,
eléctrica*, gestor de la red, refinería*, petróleo*, gas natural, barriles, central nuclear, central de carbón, electricidad, megavatios, depósitos de gas, parque eólico, parques eólicos, energía solar, oleoducto*, gasoducto*
""",
        PLAIN: """
cold spell, export ban, grid, new well, oil, reactor, rigs, supply contract, wells, windy day, gas, reservoir, dams, leak at, solar, coal, strom, kohle, förderung, öl, carbón, central eléctrica
""",
        WEAK: "energy, utilities, utility, resources, power, tank, terminal, winter, leak, well, pipeline, fuel, tanker, permit, dam, wind, netz, gas, energía, red, pozo",
    },
    "law": {
        STRONG: """
acquitt*, antitrust, appeals court, arbitrat*, attorney, bail, barrister, class action, class of shareholders, compliance breach, consent decree, convicted, counsel, court of appeal, court ruling, courtroom, cross-examin*, defendant, deposition,
disclosure failure, district court, federal judge, fined, found guilty, fraud charge, high court, indict*, injunction, judge, jurisdiction, juror, jury found, lack of standing, late filing, law firm, lawsuit, lawyer, legal duty, legal duties, litigation, motion to compel,
motion to dismiss, patent invalid, patent infringement, perjury, plaintiff, plea bargain, prosecut*, ruled that, securities act, sentenced, settlement talks, statute, subpoena, sued, supreme court, the settlement, testif*, testimony, tribunal,
verdict, whistleblower, witness, wrongdoing, bribery, unlawful, legal action, out of court, damages claim, payment in damages, sealed exhibit, trademark dispute,
kläger*, klagepunkt*, kartellbehörde*, gericht*, berufungsgericht*, staatsanwalt*, angeklagt*, geldbusse*, geldbuße*, urteil*, richter*, rechtsanwalt*, anwält*, schadenersatz*, vergleich vor, meldepflicht*, strafverfahren*,
demandante*, tribunal*, demanda contra, juez, jueza, jueces, abogad*, fiscalía, fiscal general, multa*, acuerdo extrajudicial, pretensiones, agencia de competencia, fallos de divulgación, sentencia*, recurso ante, querella*, juzgado*
""",
        PLAIN: """
adjourn, bribe, charged with, claims, damages, guilty, hearing, inquiry into, jurors, legal, oath, patented, privacy law, prison, settlement, unfair dismissal,
klage, klagen, vergleich, ermittelt, berufung, betrug*, recht, demanda, juicio, apelación, acusad*, recurso
""",
        WEAK: "jury, court, trial, exhibit, dismissal, appeal, filing, patent, fine, opinion, charge, parliament, fraud, claim, decree, bench, law, prozess, strafe, ley, fallo",
    },
    "monetary": {
        STRONG: """
bank of england, bank of issue, bank of japan, base money, basis points, bond buying, bond portfolio, bond purchase, central bank*, consumer price, consumer price index, cost of living index, deflation, deposit facility, deputy governor, discount window, ecb, federal reserve,
fomc, half-point hike, headline inflation, inflation*, interest rate decision, key rate, lira peg, monetary authority, monetary polic*, money stock, money supply, neutral rate, overnight rate, policy council, policy meeting, policy rate, policymaker, price pressure,
price stability, quantitative easing, quantitative tightening, quarter-point, rate cut, rate hike, rate-setting, real yield, repo rate, reserve requirement, sticky services, tightening cycle, pace of tightening, the fed, voting member, wage growth, percent target,
growth forecast, quarterly projection, currency peg, foreign exchange reserve,
notenbank*, zentralbank*, geldpolit*, leitzins*, teuerung*, anleihebestand*, anleihekauf*, direktoriumsmitglied*, inflationsrate*, verbraucherpreis*, ezb, geldmenge*,
banco central*, autoridad monetaria, comité de tipos, tipo oficial, tipos de interés, inflación*, política monetaria, cartera de bonos, presiones persistentes, masa monetaria, ipc
""",
        PLAIN: """
headline reading, headline figure, yield curve,
borrowing cost, consumer basket, currency, economist, government bond, hiring data, hike, inflation projection, jump in prices, minutes of the, peg, projection, rising prices, tightening, typical basket, yields, imports cheaper, liquidity,
zinssatz, zinsen, teuerung, bonos, tipos, previsión de crecimiento
""",
        WEAK: "curve, headline, governor, basket, percent, rate, prices, wages, dollar, euro, market, target, cut, forecast, voted, projection, staff economist, council, minutes, währung, divisa, precios",
    },
    "property": {
        STRONG: """
anchor tenant, apartment, apprais*, bricklayer, building permit, building site, capitalisation rate, capitalization rate, commercial real estate, construction cost, construction of, estate agent, first-time buyer, flats, freehold, home builder, homebuilder, house price,
housing estate, housing market, landlord, lease renewal, leasehold, office block, office landlord, office tower, office vacanc*, planning permission, property developer, property market, real estate, realtor, redevelopment, rent free, rental portfolio, rents,
residential building, shopping centre, shopping mall, skyscraper, square feet, square metre, student housing, tenant, the appraiser, tower project, vacancy rate, warehouse trust, waterfront, zoning, villa, roofers, occupancy, lease expir*,
immobilie*, bürovermieter*, wohnungsbau*, eigentumswohnung*, mietwohnung*, miete, mieten, mieter*, leerstand*, quadratmeter*, bauträger*, bau von, grundstück*, vermieter*, wohnungsmarkt*, hauspreise*,
fondo inmobiliario, inmobiliari*, casero*, promotora*, vivienda*, alquiler*, metros cuadrados, tasación*, locales vacíos, pisos, inquilino*, urbanización*, hipotecas sobre viviendas
""",
        PLAIN: """
building, developer wants, homes, housing, land bank, lease, leases, plot of land, rent, rental, renovat*, ring road, tower, valuation, vacanc*, wider spread, wohnung*, bauland, construcción, edificio*, piso, suelo urbano, arrendamiento
""",
        WEAK: "cranes, passing rent, properties, property, house, plot, plots, office, estate, construction, portfolio, developer, villa, city centre, mall, bau, haus, casa, obra, local",
    },
    "retail": {
        STRONG: """
apparel, average basket, boutique, cashier, checkout, clothing chain, convenience store, cosmetics, department store, discount format, discounter, drugstore, e-commerce, fashion brand, fashion label, festive week, flagship, flagship store, footfall, garment,
grocer, grocery, high street, like-for-like, loyalty card, loyalty programme, loyalty program, loyalty point, online marketplace, online order, online retailer, online shop, outlet store, own-brand, parcels a day, price tag, private label, retail chain, retailer, retailing,
same-store, self-service till, shoplift*, shop floor, shopper, shopping season, shrinkage, sneaker, store opening, supermarket, toy seller, winter sale, winter stock, underperforming shop, consumer brand, black friday, department chain, hypermarket, aisle, hangers,
onlinehändler*, kaufhaus*, kaufhäuser*, lebensmittelhändler*, einzelhandel*, einzelhändler*, supermarkt*, supermärkte*, modekette*, winterware*, pakete täglich, läden, ladenkette*, ladenschluss*, modemarke*,
cadena de supermercados, supermercado*, tienda en línea, marca de moda, ventas comparables, ropa de invierno, paquetes al día, tienda*, minorista*, comercio minorista, comercio electrónico, grandes almacenes, rebajas
""",
        PLAIN: """
average ticket, clothing, consumers, customers' basket, discount on, promotion, shop, shops, shoe, shoes, store, stores, till, toys, trading down, sales by, kunden kauf*, filialen, filiale, laden, ropa, consumidores, comercios, compras
""",
        WEAK: "brand, brands, retail, sale, sales, return, basket, chain, customer, parcel, purchase, order, toy, jewel*, delivered, christmas, preise, marke, ventas, marca, moda, temporada",
    },
    "software": {
        STRONG: """
annual recurring revenue, api, app store, bug fix, bytecode, churn, cloud provider, cloud vendor, code review, code repository, compiler, computer program, computer virus, credential, cyber*, database service, developer tool, encrypt*, engineers deploy, firewall,
hacker, hosted version, intruder, issue tracker, java, linux, login module, login page, machine learning model, malware, on-premise, open interface, open source, open-source, operating system, password, patching, phishing, platform team, plug-in, plugin,
programmer, programming, python, query engine, ransomware, recurring revenue, response latency, saas, security flaw, security hole, security patch, software engineer, software update, software maker, software developer, source code, spreadsheet, subscription product, support chat,
web browser, website, outage, seat pricing, per seat, user interface, new release, stolen credential, version control,
entwicklerteam*, cloudanbieter*, neue version, datenbankabfrage*, anmeldemodul*, gehostete*, sicherheitslücke*, softwarehersteller*, programmierer*, quellcode*, betriebssystem*, 
proveedor de nube, nueva versión, equipo de desarrollo, base de datos, inicio de sesión, aplicación alojada, programador*, ataque informático, código fuente, contraseña*, sistema operativo, actualización de seguridad
""",
        PLAIN: """
app, apps, bookkeeping app, browser, bug, code, containerised, database, deploy*, developers, hosting, hosts, latency, library, libraries, login, migrating to, pricing tier, query, repository, server, servers, user, users, version,
die app, der app, entwickler*, aktualisierung*, fehler in der, server, aplicación*, servidores, fallo de la, usuarios, informátic*
""",
        WEAK: "account, renewal, phone, update, software, cloud, containers, release, platform, security, release, patch, seat, interface, product, subscription, flaw, backup, weekend, computer, startup, technologies, systems, hosted, datenbank, anwendung, nube, versión",
    },
    "sport": {
        STRONG: """
athlet*, away game, basketball, boxing, broadcaster of the championship, champions league, championship, coach dropped, cricket, cup final, cup winner, cycling, cyclist, extra time, fifa, football, gold medal, goal difference, goalkeeper, golf, grand slam, gymnast*, hat-trick, head coach, hockey, home crowd, home game,
injury list, innings, knock-out round, knockout round, league table, marathon, match day, matchday, matches in a row, media rights, midfielder, olympi*, penalty shoot-out, play-off, playoff, quarterback, racing team, referee, relegat*, rugby, season ticket, semi-final, semifinal, skier, soccer,
sponsor of the team, sport*, sprinter, stadium, stoppage time, straight sets, striker, super bowl, swimmer, tennis, the league, touchdown, tournament, transfer window, trophy, umpire, wicket, wimbledon, world cup, world record, wrestl*, defender scored, top of the table,
fussball*, fußball*, rennstall*, die liga, bundesliga*, spieltag*, stürmer*, torwart*, elfmeter*, endspiel*, meisterschaft*, fernsehrechte*, spiele in folge, trainer der, olympia*, weltmeister*, mannschaft*, halbfinale*, sportler*,
club de fútbol, fútbol*, la liga, escudería*, delantero*, partidos seguidos, última jornada, derechos de televisión, portero*, gol, goles, campeonato*, mundial, baloncesto, estadio*, entrenador*, atleta*, olimpiad*, tenista*
""",
        PLAIN: """
arena, captain, championships, club, coach, derby, fans, foul, goals, goal, league, medal, player, race, scored, season, shot, sprint, team, olympics, penalty, verein, liga, spieler*, sieg, equipo, partido, jugador*, la final, selección, victoria
""",
        WEAK: "match, cup, final, franchise, stage, tour, gold, title, win, won, draw, record time, tickets, broadcaster, track, table, spiel, sieg, ganó, jugará, copa",
    },
    "transport": {
        STRONG: """
air traffic, aircraft, airline, airport, aviation, bus company, cabin crew, car factory, car maker, carmaker, automaker, car plant, cargo, container freight, container line, container port, container ship, diesel car, electric car, electric van, electric vehicle,
ferry, fleet of truck, freight, fuel surcharge, hatchback, hauli*, jetliner, load factor, locomotive, lorry, lorries, motorway, passenger, port strike, quay, rail freight, rail line, railroad, railway, road haulage, rolling stock, runway, sedan, ship owner, shipowner, shipping company, shipping line,
shipyard, short-haul, spot rate, the carrier, timetable, train driver, train to, trains, tram, tramway, truck driver, trucker, trucking, wheel loader, faulty brake, bus fare, merchant ship, cargo ship, pilots, ran aground,
reederei*, fluglinie*, fluggesellschaft*, autobauer*, autohersteller*, lokomotive*, passagier*, flughafen*, güterzug*, güterverkehr*, bahnstrecke*, containerschiff*, frachter*, lastwagen*, schiffe, fahrzeug*, die bahn, spedition*, zugverkehr*,
naviera*, aerolínea*, fábrica de coches, locomotora*, buque*, pasajero*, aeropuerto*, vuelos, tren, trenes, ferrocarril*, camion*, vehículos, transportista*, portacontenedores
""",
        PLAIN: """
drivers,
bus, cars, crew, delivery van, flight, flights, fares, harbour, jets, plane, port, rail, route, ship, ships, traffic, train, truck, van, vehicle, wagen, zug, züge, schiff, kap, coche*, vuelo, barco*, puerto, carretera*
""",
        WEAK: "pilot, vessel, cape, seats, container, containers, carrier, motors, logistics, driver, terminal, boxes, canal, border, wheel, line, box, strecke, seite, línea, cabo",
    },
}

#: Openings of a remark in passing: what follows in the sentence is not what the text is about.
PASSING = (
    "in other news", "as an aside", "by the way", "incidentally", "on another note", "off topic", "unrelated to this", "reader asked", "readers asked",
    "nur am rande", "nebenbei bemerkt", "übrigens", "davon unabhängig", "leser fragte", "leserin fragte",
    "sin relación con lo anterior", "al margen de esto", "por cierto", "dicho sea de paso", "lector preguntó", "lectora preguntó",
)

#: Standing notices, which belong to the medium and not to the text.
NOTICES = (
    "all rights reserved", "copyright ©", "end of notice", "end of message", "forward-looking statements", "to leave this list", "to unsubscribe", "unsubscribe from", "this message is confidential",
    "source: company information", "figures unaudited", "unaudited figures", "not investment advice",
    "alle rechte vorbehalten", "keine anlageberatung", "abbestellen", "todos los derechos reservados", "darse de baja",
)


def _terms(text: str) -> list[str]:
    return [t.strip() for t in text.replace("\n", " ").split(",") if t.strip()]


#: (subject, term, weight) in the order above; a term that a subject lists twice has the greater weight.
VOCABULARY: tuple[tuple[str, str, float], ...] = tuple(
    (s, t, w) for s, kinds in _TEXT.items() for t, w in {t: w for w in (WEAK, PLAIN, STRONG) for t in _terms(kinds[w])}.items()
)
