"""Sentences in plain words, by subject, that share no phrase with the test corpus; the last group is about none of the subjects.

They were written before the vocabulary and aren't changed to suit it.
"""

SENTENCES: dict[str, tuple[str, ...]] = {
    "agrifood": (
        "Heavy rain delayed the maize harvest in the valley.",
        "The farmer sprayed his potato fields against blight.",
        "Pigs and poultry were moved after the outbreak of bird flu.",
        "Olive oil became expensive once the groves dried out.",
        "A tractor pulled the plough across the stubble.",
        "Beekeepers worry about pesticides on rapeseed.",
        "The bakery buys its flour from a local miller.",
        "Vineyards in the south picked their grapes two weeks early.",
        "Feed costs squeeze livestock breeders.",
        "Cocoa and coffee growers asked for a minimum price.",
        "The slaughterhouse failed a hygiene inspection.",
        "Die Landwirte säen den Roggen später als sonst.",
        "Der Bauernverband klagt über niedrige Milchpreise.",
        "Los ganaderos vendieron sus vacas por falta de pasto.",
        "La cosecha de maíz fue la peor en diez años.",
    ),
    "banking": (
        "Customers queued outside the branch to withdraw their savings.",
        "The mortgage lender raised its interest rates on home loans.",
        "A credit union merged with its larger neighbour.",
        "Borrowers who miss repayments face higher fees.",
        "Regulators want banks to hold more equity against risky assets.",
        "Her overdraft was cancelled without notice.",
        "Bad debts ate up most of the bank's profit.",
        "The bank run began with a rumour about deposits.",
        "Cash machines stayed empty over the weekend.",
        "Basel rules limit how much leverage a bank may take.",
        "He refinanced his loan at a lower rate.",
        "Die Bank erhöht die Zinsen auf Spareinlagen.",
        "Viele Kreditnehmer können ihre Raten nicht mehr zahlen.",
        "El banco denegó la hipoteca a la pareja.",
        "La morosidad de los préstamos subió otra vez.",
    ),
    "biomed": (
        "The nurse gave antibiotics against pneumonia.",
        "A new vaccine protects infants from measles.",
        "Patients with diabetes inject insulin every day.",
        "The surgeon replaced the worn hip joint.",
        "Researchers found a gene mutation behind the disease.",
        "The hospital ordered two more scanners for its radiology ward.",
        "Side effects of the drug include nausea and headaches.",
        "Blood samples were sent to the laboratory.",
        "Chemotherapy shrank the cancer within months.",
        "The pharmacist refused to fill the prescription.",
        "A pacemaker keeps the heart beating evenly.",
        "Das Medikament senkt den Blutdruck.",
        "Ärzte im Krankenhaus behandeln mehr Infektionen.",
        "El hospital probó un tratamiento contra el cáncer.",
        "La vacuna protege a los niños del sarampión.",
    ),
    "dataops": (
        "The import job crashed because a column was missing in the CSV file.",
        "Yesterday's prices were loaded twice and had to be deduplicated.",
        "Two ISIN codes point to the same ticker symbol in the reference data.",
        "The pipeline retried the download until the vendor's server answered.",
        "Stale quotes reached the database before anyone noticed.",
        "A parser choked on an unexpected timestamp format.",
        "Missing rows were filled from the backup feed.",
        "The data vendor changed the layout of its daily file.",
        "Our ETL run finished late and the dashboards showed old values.",
        "Corporate actions must be applied before the history is adjusted.",
        "Records without a primary key are rejected by the loader.",
        "Der Datenfeed lieferte falsche Schlusskurse.",
        "Die Datei enthielt leere Spalten und ungültige Werte.",
        "La importación falló por un campo vacío en el fichero.",
        "El identificador del valor no coincide con el de la base de referencia.",
    ),
    "electronics": (
        "The smartphone's processor overheats under load.",
        "A shortage of microchips stopped the assembly line.",
        "Engineers soldered the capacitor onto the circuit board.",
        "The company makes semiconductors for cars.",
        "LED screens use less power than older monitors.",
        "Lithography machines etch tiny patterns into silicon.",
        "The graphics card has twice as many cores.",
        "Flash memory prices fell for the third month.",
        "Printed circuits are inspected under a microscope.",
        "The amplifier needs a new resistor.",
        "Contract manufacturers assemble laptops and tablets.",
        "Der Halbleiterhersteller baut eine neue Chipfabrik.",
        "Die Leiterplatten kommen aus Taiwan.",
        "La escasez de chips frenó la producción de móviles.",
        "El fabricante de semiconductores amplía su planta.",
    ),
    "energy": (
        "The power station burns natural gas.",
        "A blackout hit the city after the substation caught fire.",
        "OPEC agreed to cut oil production.",
        "Drivers paid more for petrol and diesel.",
        "The nuclear reactor was switched off for maintenance.",
        "Shale wells in Texas produce less than expected.",
        "Hydroelectric dams ran low during the drought.",
        "Electricity prices turned negative on a windy day.",
        "The tanker carried liquefied natural gas to Japan.",
        "Rooftop solar now supplies a tenth of the kilowatt hours used.",
        "A leak in the pipeline spilled crude into the river.",
        "Der Strompreis stieg nach dem Ausfall des Kernkraftwerks.",
        "Windräder liefern mehr Strom als Braunkohle.",
        "El petróleo subió tras el recorte de la producción.",
        "La central nuclear volvió a generar electricidad.",
    ),
    "law": (
        "The defendant's attorney asked for bail.",
        "A jury found him guilty of fraud.",
        "The supreme court overturned the verdict.",
        "Lawyers filed a class action against the airline.",
        "The witness testified under oath.",
        "Prosecutors charged two managers with bribery.",
        "The company was sued for copying a patented design.",
        "Parliament passed a statute on privacy.",
        "The judge adjourned the hearing until Monday.",
        "He was sentenced to three years in prison.",
        "A tribunal ruled that the dismissal was unlawful.",
        "Der Angeklagte legte Berufung gegen das Urteil ein.",
        "Die Staatsanwaltschaft ermittelt wegen Betrugs.",
        "El juez archivó la demanda contra la empresa.",
        "El abogado presentó un recurso ante el tribunal supremo.",
    ),
    "monetary": (
        "The Federal Reserve left its key rate unchanged.",
        "Consumer prices rose faster than wages.",
        "The ECB will stop buying government bonds.",
        "Inflation fell below two percent for the first time in years.",
        "Quantitative easing flooded the markets with liquidity.",
        "The governor of the Bank of England warned of rising prices.",
        "Policymakers voted for a half-point hike.",
        "Deflation is the greater danger, the economist said.",
        "The peg to the dollar limits monetary policy.",
        "A stronger currency makes imports cheaper and slows inflation.",
        "Markets expect two rate cuts this year.",
        "Die Europäische Zentralbank senkt die Leitzinsen.",
        "Die Inflationsrate liegt über dem Ziel.",
        "El Banco Central Europeo subió los tipos de interés.",
        "La inflación interanual bajó al tres por ciento.",
    ),
    "property": (
        "House prices fell for the fourth month in a row.",
        "Tenants refuse to pay the higher rent.",
        "The landlord renovated the apartment block.",
        "A developer wants to build two hundred homes on the old airfield.",
        "Office vacancies in the city centre reached a record.",
        "The estate agent sold the villa within a week.",
        "Construction of the skyscraper has stopped.",
        "Planning permission for the housing estate was denied.",
        "Bricklayers and roofers are hard to find.",
        "The mall's owner cut the leases of small shops.",
        "Commercial real estate lost a fifth of its value.",
        "Die Mieten in der Innenstadt steigen weiter.",
        "Der Bauträger errichtet achtzig Eigentumswohnungen.",
        "El precio de la vivienda subió en todas las ciudades.",
        "El alquiler de pisos se encarece en verano.",
    ),
    "retail": (
        "The supermarket cut the price of bread.",
        "Shoppers queued for the winter sale.",
        "The clothing chain will close thirty stores.",
        "Online orders are delivered to the door the same day.",
        "A discount on toys drew families to the shop.",
        "The fashion label opened a boutique in Milan.",
        "Cashiers were replaced by self-service tills.",
        "Consumers returned a third of the shoes they bought.",
        "The retailer's loyalty card gives points for every purchase.",
        "Shoplifting cost the drugstore chain millions.",
        "Christmas sales at department stores disappointed.",
        "Der Supermarkt senkt die Preise für Butter.",
        "Die Modekette schließt jede zweite Filiale.",
        "La tienda vendió toda la ropa de la temporada.",
        "Los consumidores compran más por internet que en los comercios.",
    ),
    "software": (
        "The compiler turns the source into bytecode.",
        "Hackers exploited a bug in the web browser.",
        "The programmer pushed his code to the repository.",
        "Users must update the operating system before Friday.",
        "A cloud provider hosts the company's servers.",
        "The startup sells an app for bookkeeping.",
        "Ransomware encrypted the city's computers.",
        "Developers test every release before they ship it.",
        "The database query takes three seconds.",
        "Passwords were stolen from the login page.",
        "Open source libraries save months of work.",
        "Die Entwickler beheben den Fehler in der App.",
        "Das Update schließt eine Sicherheitslücke.",
        "Los programadores corrigieron un fallo de la aplicación.",
        "Un ataque informático bloqueó los servidores.",
    ),
    "sport": (
        "The goalkeeper saved a shot in stoppage time.",
        "The quarterback threw for a touchdown.",
        "She won the marathon in record time.",
        "The coach dropped his captain before the semi-final.",
        "Fans filled the arena for the boxing match.",
        "The sprinter took gold at the Olympics.",
        "A hat-trick sent the visitors top of the table.",
        "The tennis player lost in straight sets.",
        "Cyclists climb two passes on the last stage of the tour.",
        "The striker was sent off after the foul.",
        "The world cup draw takes place in December.",
        "Der Torwart hielt den Elfmeter.",
        "Die Mannschaft gewann das Endspiel.",
        "El equipo ganó el partido con un gol en el último minuto.",
        "La selección jugará la final del mundial.",
    ),
    "transport": (
        "The train to Lyon was cancelled because of a strike.",
        "A cargo ship ran aground in the canal.",
        "The airline ordered forty jets.",
        "Lorries wait for hours at the border.",
        "The carmaker sells more electric vehicles than diesel cars.",
        "Passengers were stranded at the airport overnight.",
        "The tram line will be extended to the harbour.",
        "Container freight between Asia and Europe got cheaper.",
        "A truck driver may not be at the wheel for more than nine hours.",
        "The bus company raised its fares.",
        "Pilots and cabin crews want shorter shifts.",
        "Die Bahn streicht Züge auf der Strecke nach Köln.",
        "Der Autohersteller ruft eine Million Wagen zurück.",
        "El aeropuerto canceló veinte vuelos por la niebla.",
        "El tren de alta velocidad llegó con retraso.",
    ),
    "": (
        "Escape the cape!",
        "The plots thicken in the novel.",
        "Containers of soup stood on the stove.",
        "Birds sing in the morning.",
        "She put the vessels of clay on the shelf.",
        "The frost on the window looked like flowers.",
        "He has a heart of gold.",
        "They met in court shoes and a long coat.",
        "A branch fell from the old oak.",
        "The bank of the river was muddy.",
        "The chip on his shoulder never went away.",
        "The jury of the film festival liked the comedy.",
        "We spent the interest of an afternoon on chess books.",
        "Her current mood is calm.",
        "The board of trustees meets on Tuesday.",
        "The choir practised for the concert.",
        "His uncle teaches history at a village school.",
        "The castle was painted white in the nineteenth century.",
        "Clouds moved over the hills.",
        "A virus of laughter spread through the room.",
        "The pilot episode was shown on Sunday.",
        "Please release the door handle slowly.",
        "The match burned down to his fingers.",
        "The shares closed higher in thin trading.",
        "Management confirmed its guidance for the year.",
        "The company named a new chief financial officer.",
        "Das Konzert begann mit einer Stunde Verspätung.",
        "Die Kinder spielten im Garten.",
        "El museo abre los lunes.",
        "La novela cuenta la vida de un pintor.",
    ),
}
